import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk

SCHEMA = "vec_id long, embedding array<float>, q string, x string, rank int, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "q", "x", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k=10, every=100):
    sound = [(i, [int(np.floor(1024 * float(np.float32(a)))) for a in v]) for i, v in rows
             if v is not None and all(a is not None and np.isfinite(a) for a in v)]
    out = []
    for i, v in sound:
        if i is not None and i % every == 0:
            found = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in sound if j != i))
            out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [(16384, 1024), (37, 2)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, .3, 40).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]                     # ties
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_pruning_keeps_all_of_the_best():
    rng = np.random.default_rng(5)
    cands = rng.integers(-300, 300, (64, 500))
    queries = rng.integers(-300, 300, (64, 5))
    cands[:, 100:140] = cands[:, [3]]
    found = topk.search_block(queries, cands, [np.array([], int)] * 5, np.arange(500), 10)
    for q, (at, score) in enumerate(found):
        exact = queries[:, q] @ cands
        want = np.lexsort((np.arange(500), -exact))[:10]
        assert at.tolist() == want.tolist() and score.tolist() == exact[want].tolist()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, []),
            (7, [1.0]), (None, [3.0, 3.0]), (100, [0.0, -1.0])]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert topk.top_k(table(spark, rows).limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert topk.top_k(table(spark, [(0, [1.0])]), F.col("vec_id") % 100 == 0).collect() == []
    twice = topk.top_k(table(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])]), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, twice.collect())) == [(0, 1, 1, 2048 * 1024)] * 2 + [(0, 2, 1, 2048 * 1024)] * 2


@pytest.mark.parametrize("blocks", [(16384, 1024), (37, 2)])
def test_large_components_stay(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, .3, 64).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, (rng.normal(0, 1, 64) * 10.0 ** rng.integers(3, 6)).astype(np.float32).tolist()) for i in range(40)]
    rows += [(1000, rows[310][1]), (1100, [2.0 ** 24] + [0.0] * 9)]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0)
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(j is not None and j >= 400 for _, _, j, _ in want)


def test_wide_products_are_exact_and_beyond_a_long_they_fail(spark):
    rng = np.random.default_rng(7)
    cands = rng.integers(-(1 << 62), 1 << 62, (8, 50))
    cands[:, 20:] >>= 50
    queries = np.hstack([rng.integers(-8, 8, (8, 3)), cands[:, :2]])
    found = topk.search_cell(queries, cands, [np.array([4])] * 5, np.arange(50), 10)
    for q, (at, score) in enumerate(found):
        exact = [sum(int(a) * int(b) for a, b in zip(queries[:, q], cands[:, c])) for c in range(50)]
        want = sorted((c for c in range(50) if c != 4), key=lambda c: (-exact[c], c))[:10]
        assert at.tolist() == want
        assert score.tolist() == [min(max(exact[c], topk.LEAST), topk.MOST) for c in want]
    big = [(0, [2.0 ** 40]), (1, [2.0 ** 40]), (2, [-(2.0 ** 40)]), (3, [1.0]), (4, [2.0])]
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(table(spark, big), F.col("vec_id") % 100 == 0).collect()
    rest = topk.top_k(table(spark, [r for r in big if r[0] != 1]), F.col("vec_id") % 100 == 0, k=2).collect()
    assert [(r.vec_id, r.score) for r in rest] == [(4, 2 ** 61), (3, 2 ** 60)]       # 2 lies below a long, and is not asked for


@pytest.mark.parametrize("blocks", [(16384, 1024), (5, 2)])
def test_components_beyond_a_long_stay(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(8)
    # a query that is zero where others are far, one that is far itself, and candidates far on the lower side
    rows = [(i, [0.0, *rng.normal(0, 1, 5).tolist()]) for i in range(1, 40)] + [(0, [0.0, 1.0, 1.0, 1.0])]
    rows += [(200, [1e30, 0.0, 0.0, 0.0]), (41, [-1e30, 1.0]), (42, [-3e38, 0.0, 9.0]), (44, [0.0, 1e6, 1e6]),
             (45, [-(2.0 ** 53), 50.0, 50.0, 50.0])]
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(table(spark, [*rows, (46, [2.0 ** -10])]), F.col("vec_id") % 100 == 0).collect()
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert {42, 45} <= {r.vec_id for r in got if r.query_id == 0}
