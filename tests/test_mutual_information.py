import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.selection import digamma, knn_mutual_information


def brute(x, y, k):
    """The estimator from all distances."""
    psi = lambda m: -0.5772156649015329 + math.fsum(1 / i for i in range(1, m))
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        apart = np.abs(x - x[i])
        same = np.flatnonzero((y == y[i]) & (np.arange(len(x)) != i))
        kk = min(k, len(same))
        d = np.sort(apart[same])[kk - 1]
        m = int((apart < d).sum()) if d > 0 else int((apart == 0).sum())
        total += psi(kk) - psi(len(same) + 1) - psi(m)
    return max(0.0, psi(len(x)) + total / len(x))


@pytest.fixture(scope="module")
def table(spark):
    """2,000 rows: dense, tied, near-constant and independent features; a class of one row, a small one."""
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 2000)
    y[:3], y[3] = 7, 8
    cols = {"shifted": rng.normal(size=2000) + y, "noise": rng.normal(size=2000),
            "tied": np.round(rng.normal(size=2000) * 4 + y) / 8, "flag": (rng.random(2000) < 0.3 + 0.3 * (y == 1)) * 1.0,
            "constant": np.full(2000, 2.5), "rare": np.where(rng.random(2000) < 0.002, rng.normal(size=2000), -0.0)}
    rows = [(int(c), *[float(v[i]) for v in cols.values()]) for i, c in enumerate(y)]
    df = spark.createDataFrame(rows, "target int, " + ", ".join(f"{c} double" for c in cols))
    return df, cols, y


@pytest.mark.parametrize("k, chunk", [(3, 100_000), (3, 50), (1, 100_000), (7, 8)])
def test_equals_brute_force(table, k, chunk):
    df, cols, y = table
    got = {r.feature: r.mutual_info for r in knn_mutual_information(df, list(cols), k=k, chunk_rows=chunk).collect()}
    want = {c: brute(x, y, k) for c, x in cols.items()}
    assert set(got) == set(want)
    for c in cols:
        assert got[c] == pytest.approx(want[c], abs=2e-9), c
    assert got["shifted"] > 0.05 > got["noise"]


def test_windows_see_the_edges_of_blocks_only(spark, table, monkeypatch):
    from tessera.operators import windows
    df, cols, y = table
    seen, whole = [], windows.by_chunk
    monkeypatch.setattr(windows, "by_chunk", lambda d, *a, **kw: seen.append(d.count()) or whole(d, *a, **kw))
    got = knn_mutual_information(df, ["shifted", "flag"], chunk_rows=500)
    assert 0 < seen[0] <= 4 * 3 * 3 * 6                      # 4 k a class and block, not 2,000 rows
    # many classes in blocks of few rows each: every value waits for other blocks
    many = df.withColumn("target", F.pmod(F.xxhash64("shifted"), F.lit(40)))
    got = {"few": got, "many": knn_mutual_information(many, ["shifted", "tied"], chunk_rows=64)}
    classes = {"few": y, "many": np.array([r.target for r in many.select("target").collect()])}
    for name, out in got.items():
        for r in out.collect():
            assert r.mutual_info == pytest.approx(brute(cols[r.feature], classes[name], 3), abs=2e-9), (name, r.feature)


def test_edges(spark, table):
    df, cols, _ = table
    assert knn_mutual_information(df.limit(0), ["noise"]).collect() == []
    assert knn_mutual_information(df.where("target = 8"), ["noise"]).collect() == []
    unlabelled = df.unionByName(df.limit(50).withColumn("target", F.lit(None).cast("int")))
    same = lambda d: knn_mutual_information(d, ["tied"]).first().mutual_info
    assert same(unlabelled) == same(df)
    with pytest.raises(Exception, match="value in every row"):
        knn_mutual_information(df.withColumn("noise", F.when(F.col("target") == 1, F.col("noise"))), ["noise"]).collect()


def test_digamma():
    for m in (1, 2, 3, 10, 1000):
        assert digamma(float(m), math.log) == pytest.approx(-0.5772156649015329 + math.fsum(1 / i for i in range(1, m)), abs=1e-12)
