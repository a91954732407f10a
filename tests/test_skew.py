import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import ranges
from tessera.operators.ema import running_ema
from tessera.operators.sequences import sequences_with_horizon
from tessera.operators.splits import split_by_position
from tessera.operators.windows import apply_per_series, by_chunk, chunk_positions, lagged_matrix, rolling_matrix, running_mean

KEY = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark):
    """One key with most rows, all of them on one day; some values missing."""
    rng = np.random.default_rng(0)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(seconds=int(i // 3)), i, float(rng.normal())) for i in range(3000)]
    for u in range(5):
        rows += [(f"u{u}", t0 + dt.timedelta(hours=5 * i), 10_000 + 100 * u + i, float(rng.normal())) for i in range(40)]
    return spark.createDataFrame(rows, "user_id string, ts timestamp, event_id long, value double")


def by_user(events):
    pdf = events.toPandas().sort_values(["user_id", *KEY]).reset_index(drop=True)
    return pdf, pdf.groupby("user_id")["value"]


def ordered(df):
    return df.toPandas().sort_values(["user_id", *KEY]).reset_index(drop=True)


def test_lags_and_rolling_match_pandas(events):
    pdf, g = by_user(events)
    got = ordered(lagged_matrix(events, ["value"], [1, 2, 5], "user_id", KEY, chunk_rows=97))
    want = pdf.assign(**{f"value_lag{k}": g.shift(k) for k in (1, 2, 5)})[g.cumcount() >= 5].reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)
    got = ordered(rolling_matrix(events, ["value"], [3, 8], ["mean", "std", "min"], "user_id", KEY, chunk_rows=50))
    for n in (3, 8):
        roll = g.rolling(n, min_periods=1)
        assert np.allclose(got[f"value_mean{n}"], roll.mean().to_numpy())
        assert np.allclose(got[f"value_std{n}"], roll.std(ddof=0).to_numpy(), atol=1e-7)
        assert np.allclose(got[f"value_min{n}"], roll.min().to_numpy())


def test_look_ahead_and_horizon(events):
    pdf, g = by_user(events)
    got = ordered(by_chunk(events, lambda w: [F.lead("value", 4).over(w).alias("n4"), F.lag("value", 2).over(w).alias("p2")],
                           "user_id", KEY, before=2, after=4, chunk_rows=33))
    assert np.allclose(got["n4"], g.shift(-4), equal_nan=True) and np.allclose(got["p2"], g.shift(2), equal_nan=True)
    seqs = sequences_with_horizon(events, ["value"], 6, 2, "user_id", KEY, chunk_rows=41)
    assert seqs.count() == (3000 - 7) + 5 * (40 - 7)
    r = seqs.where("user_id = 'hot'").orderBy(*KEY).collect()[50]
    hot = pdf[pdf.user_id == "hot"]["value"].to_numpy()
    assert [x[0] for x in r.X] == hot[50:56].tolist() and [x[0] for x in r.Y] == hot[56:58].tolist()


def test_running_forms_cross_ranges(spark, events):
    pdf, g = by_user(events)
    got = ordered(running_mean(events, "value", "user_id", KEY))
    assert np.allclose(got["value_expanding"], g.expanding().mean().to_numpy())
    gaps = events.withColumn("value", F.when(F.col("event_id") % 5 < 4, None).otherwise(F.col("value")))
    filled = ordered(ranges.fill(gaps, "value", ["user_id"], KEY))
    own = ordered(gaps)
    want = own.groupby("user_id")["value"].transform(lambda s: s.ffill().bfill()).fillna(0.0)
    assert np.allclose(filled["value"], want)


def gappy_events(events):
    """Gaps of all lengths up to 1,500 rows, a NaN, users without a value at the start or at all."""
    at = F.col("event_id")
    gap = ((at % 5 < 2) | at.between(900, 2400) & (at % 97 != 0) | at.between(2900, 2999)
           | at.between(10_000, 10_009) | at.between(10_100, 10_139))
    return events.withColumn("value", F.when(gap, None).when(at == 13, F.lit(float("nan"))).otherwise(F.col("value")))


@pytest.mark.parametrize("spans, chunk", [([2, 3], 70), ([9, 26], 1030), ([26], 100_000)])
def test_running_ema_matches_pandas(events, spans, chunk):
    pdf, g = by_user(gappy_events(events))
    got = ordered(running_ema(gappy_events(events), "value", spans, "user_id", KEY, chunk_rows=chunk))
    assert len(got) == len(pdf)
    for s in spans:
        want = g.transform(lambda v, s=s: v.ewm(span=s, adjust=False).mean())
        assert want.isna().sum() == 2 + 12 + 40 + 3 * 2 and np.allclose(got[f"ema_{s}"], want, rtol=1e-12, atol=1e-13, equal_nan=True)


def test_running_ema_edges(spark, events):
    assert running_ema(events.limit(0), "value", [5], "user_id", KEY).collect() == []
    with pytest.raises(ValueError):
        running_ema(events, "value", [26], "user_id", KEY, chunk_rows=1000)
    named = events.where("user_id is null or user_id = 'u1'").withColumn("user_id", F.lit(None).cast("string"))
    out = ordered(running_ema(named, "value", [4], "user_id", KEY, names=["slow"]))
    assert np.allclose(out["slow"], out["value"].ewm(span=4, adjust=False).mean())


def test_function_per_series_matches_pandas(events):
    def ranks(rows):                        # place of a value among itself, three before and two after
        v = rows["value"]
        near = [v.shift(k) for k in (3, 2, 1, -1, -2)]
        return rows[["user_id", *KEY]].assign(rank=sum((x < v).astype("int64") for x in near))

    schema = "user_id string, ts timestamp, event_id long, rank long"
    pdf, _ = by_user(events)
    want = pd.concat([ranks(rows) for _, rows in pdf.groupby("user_id")]).reset_index(drop=True)
    for chunk in (4, 50, 100_000):
        got = ordered(apply_per_series(events, ranks, schema, "user_id", KEY, 3, 2, chunk_rows=chunk))
        assert (got["rank"].to_numpy() == want["rank"].to_numpy()).all() and len(got) == len(want)
    assert apply_per_series(events.limit(0), ranks, schema, "user_id", KEY, 3, 2).collect() == []
    with pytest.raises(Exception, match="rows returned"):
        apply_per_series(events, lambda rows: ranks(rows).head(1), schema, "user_id", KEY, 3).collect()


def test_positions_and_position_split(events):
    pos = ordered(ranges.positions(events, ["user_id"], KEY))
    assert (pos["_pos"] == pos.groupby("user_id").cumcount()).all()
    assert set(pos[pos.user_id == "hot"]["_n"]) == {3000}
    split = ordered(split_by_position(events, "user_id", KEY))
    assert split[split.user_id == "hot"]["split"].tolist() == ["train"] * 2100 + ["val"] * 450 + ["test"] * 450


def test_hot_key_is_split(spark, events):
    c = chunk_positions(events, "user_id", KEY, before=5, chunk_rows=100)
    hot = c.where((F.col("user_id") == "hot") & ~F.col("_halo"))
    assert hot.select("_chunk").distinct().count() == 30 and hot.select("_pos").distinct().count() == 3000
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"      # else small ranges are put together
    spark.conf.set(coalesce, "false")
    try:
        r = ranges.Ranges(events, ["user_id"], KEY)
        assert r.rows.where("user_id = 'hot'").select("_range").distinct().count() > 2
        pos = ordered(ranges.positions(events, ["user_id"], KEY))
        assert (pos["_pos"] == pos.groupby("user_id").cumcount()).all()
        _, g = by_user(events)
        assert np.allclose(ordered(running_mean(events, "value", "user_id", KEY))["value_expanding"],
                           g.expanding().mean().to_numpy())
        gaps = events.withColumn("value", F.when(F.col("event_id") % 500 < 499, None).otherwise(F.col("value")))
        own = ordered(gaps)
        want = own.groupby("user_id")["value"].transform(lambda s: s.ffill().bfill()).fillna(0.0)
        assert np.allclose(ordered(ranges.fill(gaps, "value", ["user_id"], KEY))["value"], want)
    finally:
        spark.conf.unset(coalesce)


def test_quantiles_and_sums_without_groups(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=2001), 2)
    df = spark.createDataFrame([(float(v), None if v > 2 else "a") for v in x] + [(None, "a")], "x double, g string")
    got = {r.q: r.value for r in ranges.quantiles(df, "x", [], [0.0, 0.01, 0.5, 0.99, 1.0]).collect()}
    assert all(np.isclose(got[q], np.quantile(x, q)) for q in got) and len(got) == 5
    by = {r.g: r.value for r in ranges.quantiles(df, "x", ["g"], [0.3]).collect()}
    assert np.isclose(by["a"], np.quantile(x[x <= 2], 0.3)) and np.isclose(by[None], np.quantile(x[x > 2], 0.3))
    sums = ranges.running_sums(df.where("x is not null").withColumn("one", F.lit(1)), [], [F.col("x").desc()], ["one"])
    top = sums.agg(F.max("cum_one"), F.max("all_one")).first()
    assert tuple(top) == (2001, 2001)
    assert ranges.quantiles(df.limit(0), "x", [], [0.5]).collect() == []


def test_too_many_groups_for_literals_is_an_error(spark):
    df = spark.range(20).withColumn("v", F.rand(1))
    with pytest.raises(ValueError):
        ranges.with_group_values(df, df, ["id"], ["v"], most=5)
