import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import sequences as Q
from tessera.operators.windows import lagged_matrix, rolling_matrix


def _series(spark, n, f, seed=0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, f))
    rows = [(("s", i) + tuple(float(v) for v in data[i])) for i in range(n)]
    cols = ["key", "t"] + [f"f{j}" for j in range(f)]
    return spark.createDataFrame(rows, cols), data


def test_create_sequences_count_and_values(spark):
    df, data = _series(spark, 100, 5)
    out = Q.sequences_with_horizon(df, [f"f{j}" for j in range(5)], 10, 1, "key", "t").orderBy("t").collect()
    assert len(out) == 100 - 10 - 1 + 1
    first = np.array(out[0]["X"])
    assert first.shape == (10, 5) and np.allclose(first, data[:10])
    assert np.allclose(out[0]["Y"], data[10])


def test_create_sequences_too_long_fails(spark):
    df, _ = _series(spark, 8, 2)
    with pytest.raises(Exception):
        Q.sequences_with_horizon(df, ["f0", "f1"], 6, 3, "key", "t").collect()


def test_pad_lengths_and_longer_fails(spark):
    rows = [(1, [[1.0, 1.0, 1.0]] * 5), (2, [[2.0, 2.0, 2.0]] * 8), (3, [[3.0, 3.0, 3.0]] * 3)]
    df = spark.createDataFrame(rows, "id int, s array<array<double>>")
    out = df.select("id", Q.pad_vectors("s", 10, 3, "post").alias("p"), F.size("s").alias("n")).orderBy("id").collect()
    assert [r["n"] for r in out] == [5, 8, 3]
    assert all(len(r["p"]) == 10 and len(r["p"][0]) == 3 for r in out)
    assert out[2]["p"][3] == [0.0, 0.0, 0.0]
    with pytest.raises(Exception):
        df.select(Q.pad_vectors("s", 4, 3)).collect()


def test_truncate_keeps_head_and_flatten(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]],)], "s array<array<double>>")
    r = df.select(Q.truncate("s", 2).alias("t"), Q.flatten_sequence("s").alias("f")).first()
    assert r["t"] == [[1.0, 2.0], [3.0, 4.0]] and r["f"] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_lagged_and_rolling_widths(spark):
    df, data = _series(spark, 50, 5)
    feats = [f"f{j}" for j in range(5)]
    lag = lagged_matrix(df, feats, [1, 2, 3], "key", "t")
    assert len(lag.columns) - 2 == 20 and lag.count() == 47
    roll = rolling_matrix(df, feats, [5, 10], ["mean", "std"], "key", "t")
    assert len(roll.columns) - 2 == 20
    r = roll.orderBy("t").collect()
    # partial windows at the start, population std
    assert np.isclose(r[1]["f0_mean5"], data[:2, 0].mean()) and np.isclose(r[1]["f0_std5"], data[:2, 0].std())


def test_sliding_sequences_skip_short_series(spark):
    rows = [("a", dt.date(2020, 1, d), float(d), 1) for d in range(1, 11)]
    rows += [("b", dt.date(2020, 1, d), float(d), 0) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, x double, target int")
    s = Q.sliding_sequences(df, ["x"], 5).collect()
    assert len(s) == 6 and all(r["Ticker"] == "a" for r in s)


def test_caps_and_samples_are_spread_by_hash(spark):
    rows = [(f"s{i % 7}", i, float(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "Ticker string, Date int, x double")
    got = Q.capped(df, 70, 1).collect()
    assert len(got) == 70 and len({r["Ticker"] for r in got}) == 7
    import hashlib
    order = sorted(rows, key=lambda r: hashlib.md5(f"1|{r[0]}|{r[1]}".encode()).hexdigest())
    assert {(r["Ticker"], r["Date"]) for r in got} == {r[:2] for r in order[:70]}
    again = Q.sample_rows(df.repartition(5), 70, 1, ["Ticker", "Date"]).collect()
    assert set(map(tuple, again)) == set(map(tuple, got))
    assert Q.capped(df, 10_000).count() == 700
    pos = Q.sample_positions(df, 0.1, 3)
    assert {r["Ticker"]: r["n"] for r in pos.groupBy("Ticker").agg(F.count("*").alias("n")).collect()} == {
        f"s{i}": 10 for i in range(7)}


def test_latest_sequence_uses_the_last_rows(spark):
    rows = [("a", i, float(i)) for i in range(30)] + [("b", i, float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "Ticker string, Date int, x double")
    got = Q.latest_sequence(df, ["x"], 5).collect()
    assert len(got) == 1 and got[0]["Date"] == 29 and got[0]["X"] == [[float(i)] for i in range(25, 30)]


def test_window_matrices_fail_on_short_series(spark):
    df, _ = _series(spark, 4, 2)
    with pytest.raises(Exception):
        rolling_matrix(df, ["f0"], [5], ["mean"], "key", "t").collect()
    with pytest.raises(Exception):
        lagged_matrix(df, ["f0"], [4], "key", "t").collect()
