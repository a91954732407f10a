"""Statistics on arrays of whole series; wide tables are not written; summaries in one pass."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from helpers import panel_df, panel_rows, random_walk
from tessera import session
from tessera.functions.scalar import rounded
from tessera.operators import selection as Sel
from tessera.operators.features import build_features
from tessera.operators.series import filled, numbered, whole_series


def test_series_are_never_divided():
    number = [1, 2, 3, 1, 1, 2, 3, 4, 5, 6, 7, 1, 2]
    for size in (1, 2, 3, 5, 20):
        batches = [pa.RecordBatch.from_arrays([pa.array(number[i:i + size])], ["n"]) for i in range(0, len(number), size)]
        got = [b.column("n").to_pylist() for b in whole_series(batches, "n")]
        assert all(g[0] == 1 for g in got) and [n for g in got for n in g] == number
    with pytest.raises(ValueError, match="order"):
        list(whole_series([pa.RecordBatch.from_arrays([pa.array([1, 2, 4])], ["n"])], "n"))


def test_fill_within_each_series(spark):
    rows = [("a", i, x, y) for i, (x, y) in enumerate([(None, 1.0), (2.0, None), (None, None), (4.0, None)])]
    rows += [("b", 0, None, None), ("c", 0, None, 7.0), ("c", 1, None, None), ("c", 2, 5.0, 8.0)]
    df = numbered(spark.createDataFrame(rows, "k string, i int, x double, y double").repartition(1), ["k"], ["i"], "n")
    got = {(r.k, r.i): (r.x, r.y) for r in filled(df, ["x", "y"], "n").collect()}
    assert got == {("a", 0): (2.0, 1.0), ("a", 1): (2.0, 1.0), ("a", 2): (2.0, 1.0), ("a", 3): (4.0, 1.0),
                   ("b", 0): (0.0, 0.0), ("c", 0): (5.0, 7.0), ("c", 1): (5.0, 7.0), ("c", 2): (5.0, 8.0)}
    causal = {(r.k, r.i): r.x for r in filled(df, ["x"], "n", back=False).collect()}
    assert causal[("a", 0)] == 0.0 and causal[("a", 2)] == 2.0 and causal[("c", 1)] == 0.0


def test_one_row_and_one_column(spark):
    one = numbered(spark.createDataFrame([("a", 0, None, 3.0)], "k string, i int, x double, y double"), ["k"], ["i"], "n")
    assert [(r.x, r.y) for r in filled(one, ["x", "y"], "n").collect()] == [(0.0, 3.0)]
    assert [(r.mean, r.m2) for r in Sel.column_moments(one, ["y"]).collect()] == [(3.0, 0.0)]
    two = spark.createDataFrame([(1.0,), (2.0,)], "y double").repartition(1)
    assert [(r.mean, r.m2) for r in Sel.column_moments(two, ["y"]).collect()] == [(1.5, 0.5)]


def test_features_take_a_few_window_functions(spark):
    df = panel_df(spark, panel_rows("A", random_walk(60, 1))).withColumn("split", F.lit("train"))
    plan = build_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition") < 20
    some = build_features(df, only=["rsi", "macd"])
    assert some.columns == ["split", "Ticker", "Date", "rsi", "macd"]


def test_rounding_equals_sparks(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, s, 300) for s in (1e-6, 1, 1e4, 1e12, 1e300)]).tolist()
    x += [0.5e-6, 1.5e-6, -2.5e-6, 0.1234565, 1.0000005, 0.0, -0.0, -1e-9, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = df.select(rounded("x", 6).alias("a"), (F.round("x", 6) + 0.0).alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    assert got.count() == 0


def test_moments_and_correlations_of_several_tasks(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(1e6, 1, 900), rng.normal(size=900), np.full(900, 0.1)])
    x = np.column_stack([x, x[:, 0] * 2 + x[:, 1]])
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double").repartition(5)
    for r in Sel.column_moments(df, names).collect():
        v = x[:, r.f]
        assert (r.n, r.lo, r.hi) == (900, v.min(), v.max())
        assert r.mean == pytest.approx(v.mean(), rel=1e-14) and r.m2 == pytest.approx(((v - v.mean()) ** 2).sum(), abs=1e-9)
    m = Sel.correlation_matrix(df, names)
    assert np.isnan(m[2]).all() and np.allclose(m[[0, 1, 3]][:, [0, 1, 3]], np.corrcoef(x[:, [0, 1, 3]].T), atol=1e-9)
    with pytest.raises(Exception, match="NULL or NaN"):
        Sel.column_moments(df.withColumn("b", F.lit(None).cast("double")), names).collect()


@pytest.mark.parametrize("query", ["scaled_features", "scaling_cell_stats", "select_features", "scaler_fit"])
def test_no_wide_table_is_written(spark, query):
    from tessera.plans.catalog import REGISTRY, load_all
    load_all()
    first = len(session._WRITTEN)
    assert REGISTRY[query][0](spark, SF).first() is not None
    assert all(len(spark.read.parquet(path).columns) < 20 for path, _ in session._WRITTEN[first:])


def test_sequences_round_each_value_once(spark):
    from tessera.plans import pipelines as Pl
    from tessera.plans.queries_features import features_table
    f = features_table(spark, SF, ["rsi", "macd"])
    exact = Pl.training_sequences(f, ["rsi", "macd"]).select("split", "Ticker", "Date", F.transform(
        "X", lambda v: F.transform(v, lambda x: F.round(x, 5) + 0.0)).alias("X"), "y")
    once = Pl.training_sequences(f, ["rsi", "macd"], digits=5)
    assert once.count() > 0 and once.exceptAll(exact).count() == 0 and exact.count() == once.count()
