from pyspark.sql import functions as F

from helpers import panel_df, panel_rows, random_walk
from tessera.operators.clean import handle_missing_values, missing_profile
from tessera.operators.labels import forward_label
from tessera.operators.splits import split_by_date, split_by_position


def test_fill_leading_and_inner_nulls(spark):
    closes = [None, None, 10.0, None, 12.0] + [12.0 + i for i in range(40)]
    df = panel_df(spark, panel_rows("A", closes))
    out = handle_missing_values(df).orderBy("Date").toPandas()
    # leading run takes the first valid value (back fill), inner gap the previous one
    assert list(out["Close"][:5]) == [10.0, 10.0, 10.0, 10.0, 12.0]


def test_all_null_volume_becomes_zero(spark):
    rows = panel_rows("A", random_walk(40, 1), volumes=[None] * 40)
    out = handle_missing_values(panel_df(spark, rows)).toPandas()
    assert (out["Volume"] == 0.0).all()


def test_short_series_and_invalid_prices(spark):
    rows = panel_rows("S30", random_walk(30, 2)) + panel_rows("S31", random_walk(31, 3))
    rows += panel_rows("BAD", random_walk(40, 4), opens=[0.0] + random_walk(39, 5))
    out = handle_missing_values(panel_df(spark, rows))
    counts = {r["Ticker"]: r["n"] for r in out.groupBy("Ticker").agg(F.count("*").alias("n")).collect()}
    assert "S30" not in counts and counts["S31"] == 31 and counts["BAD"] == 39


def test_missing_profile_lists_only_missing(spark):
    rows = panel_rows("A", [1.0, None, 3.0] + [3.0] * 40)
    prof = {r["column"]: r["missing"] for r in missing_profile(panel_df(spark, rows)).collect()}
    assert prof["Close"] == 1 and prof["High"] == 1 and prof["Open"] == 1 and "Volume" not in prof


def test_forward_label_ties_and_tail(spark):
    closes = [10.0] * 35 + [11.0] * 5
    out = forward_label(panel_df(spark, panel_rows("A", closes))).orderBy("Date").toPandas()
    assert len(out) == 40 - 30
    # close(t+30) == close(t) for the first 5 rows -> 0, then 11 > 10 -> 1
    assert list(out["target"]) == [0] * 5 + [1] * 5


def test_split_by_date_and_position(spark):
    rows = panel_rows("A", random_walk(100, 6))
    df = panel_df(spark, rows).withColumn("target", F.lit(1))
    sp = {r["split"]: r["n"] for r in split_by_date(df).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sp == {"train": 70, "val": 15, "test": 15}
    pos = {r["split"]: r["n"] for r in split_by_position(df).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert pos["train"] == 70
    # second cut: int(n*.7) + int(n*.15) differs from int(n*.85) for n = 2499 (positional rule)
    import math
    assert math.floor(2499 * 0.7) + math.floor(2499 * 0.15) == 2123


def test_ratio_check(spark):
    import pytest
    from tessera.operators.splits import check_ratios
    with pytest.raises(ValueError):
        check_ratios(0.7, 0.2, 0.2)
