"""Raw rows are combined before the one shuffle of a panel; nothing of a written table's shuffle stays."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.clean import handle_missing_values
from tessera.session import materialize
from tessera.sources.bars import combined, daily_bars

LINEITEM = "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_quantity double, l_orderkey long, l_linenumber int"


@pytest.fixture(scope="module")
def lineitem(spark):
    """A supplier with most rows, on three days; gaps in every column; rows that come twice."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        hot = rng.random() < 0.7
        day = dt.datetime(2020, 1, 1 + int(rng.integers(0, 3 if hot else 25)), int(rng.integers(0, 24)))
        row = [7 if hot else int(rng.integers(0, 20)), day, float(rng.integers(1, 500)), float(rng.integers(1, 9)),
               int(rng.integers(0, 900)), int(rng.integers(0, 4))]
        if rng.random() < 0.05:
            row[int(rng.integers(0, 6))] = None
        rows += [tuple(row)] * (2 if rng.random() < 0.1 else 1)
    rows += [(3, dt.datetime(2020, 1, 2), float("nan"), 2.0, 1, 1), (3, dt.datetime(2020, 1, 2), 4.0, 2.0, 1, 1)]
    return spark.createDataFrame(rows, LINEITEM).repartition(4)


def plain(df):
    at = F.struct("l_orderkey", "l_linenumber", "p")
    rows = df.withColumn("p", F.col("l_extendedprice") / F.col("l_quantity"))
    return rows.groupBy(F.col("l_suppkey").cast("string").alias("Ticker"), F.col("l_shipdate").cast("date").alias("Date")).agg(
        F.min_by("p", at).alias("Open"), F.max("p").alias("High"), F.min("p").alias("Low"), F.max_by("p", at).alias("Close"),
        F.sum("l_quantity").alias("Volume"))


def test_bars_equal_a_plain_aggregate(spark, lineitem):
    for df in (lineitem, lineitem.limit(0), lineitem.withColumn("l_quantity", F.col("l_quantity").cast("decimal(10,2)"))):
        want, got = plain(df), daily_bars(df)
        got = got.select(want.columns)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_hot_series_is_combined_before_the_shuffle(lineitem):
    rows = lineitem.select(F.col("l_suppkey").alias("key"), F.col("l_shipdate").cast("date").alias("Date"),
                           (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"), F.col("l_quantity").alias("q"),
                           F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln")).where("key = 7").dropna()
    assert rows.count() > 1500 and combined(rows).count() <= 4 * 4 * 3      # days, times tasks, not rows
    assert combined(rows, chunk_rows=100).agg(F.sum("q")).first() == rows.agg(F.sum("q")).first()


def test_a_panel_is_shuffled_once(lineitem):
    plan = handle_missing_values(daily_bars(lineitem))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_shuffle_files_go_when_a_table_is_written(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    shuffles = lambda: {f for f in manager.getAllFiles().mkString("|").split("|") if "/shuffle_" in f}
    before, setting = shuffles(), spark.conf.get(name)
    out = materialize(spark.range(1000).repartition(5, "id"))
    assert not shuffles() - before and spark.conf.get(name) == setting
    assert out.count() == 1000
