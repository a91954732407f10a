import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{rng.randrange(5)}"
        rows.append((i, " ".join("w" * rng.randint(1, 4) for _ in range(int(rng.lognormvariate(3, 1.2)))), source))
    return rows


def brute_targets(sizes, weights, cap):
    """Share by weight, cap, reshare the excess, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("block", [4, 256])
def test_targets_taken_and_reruns(spark, block):
    rows = corpus(600)
    got = mixing.mix_sources(docs(spark, rows), block=block).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes, (1, 2, 3), 3.0)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert own[0].target == pytest.approx(want[s])
        assert abs(sum(r.copies * r.size for r in own) - want[s]) <= 0.02 * want[s] + 3
        rate = want[s] / sizes[s]
        assert all(int(rate) <= r.copies <= min(3, int(rate) + 1) for r in own if r.size)
    again = mixing.mix_sources(docs(spark, rows).repartition(3), block=block).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_capped_sources(spark):
    rows = [(1, "a b", "a"), (2, "a " * 500, "b"), (3, "c " * 100, "c"), (4, "c " * 40, "c")]
    sizes = {"a": 2, "b": 500, "c": 140}
    got = {r.source: r.target for r in mixing.mix_sources(docs(spark, rows)).collect()}
    assert got == pytest.approx(brute_targets(sizes, (1, 2, 3), 3.0))
    assert got["a"] == 6


def test_probabilities_keep_their_mean(spark):
    rows = [(i, "w " * (1 + i % 7), "a" if i % 4 else "b") for i in range(40)]
    one = docs(spark, rows)
    taken = {}
    runs = 30
    for seed in range(runs):
        for r in mixing.mix_sources(one, block=4, seed=1000 * seed).collect():
            taken[r.source] = taken.get(r.source, 0) + r.copies
            rate = {r.source: r.target / r.source_size}
    sizes = {s: sum(1 for r in rows if r[2] == s) for s in "ab"}
    for s in "ab":
        r = mixing.mix_sources(one).where(F.col("source") == s).first()
        assert taken[s] / runs / sizes[s] == pytest.approx(r.target / r.source_size, abs=0.12)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None), (5, "q", "a"), (5, "q", "a"),
            (6, "w " * 30000, "a")]
    got = mixing.mix_sources(docs(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.copies <= 3 for r in got)
    assert {r.size for r in got} == {0, 1, 2, 30000}
    assert mixing.mix_sources(docs(spark, rows).limit(0)).collect() == []
    out = mixing.mixed_documents(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "size", "copies"]
    assert out.count() == sum(r.copies for r in got)
    assert mixing.mixed_documents(docs(spark, rows).limit(0)).collect() == []
    blank = mixing.mix_sources(docs(spark, [(1, None, None), (2, " ", "z")])).collect()
    assert len(blank) == 2 and all(r.target == 0 for r in blank)
