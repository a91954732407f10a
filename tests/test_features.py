import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import panel_df, panel_rows, random_walk
from tessera.operators.ema import with_ema
from tessera.operators.features import build_features, feature_names
from tessera.operators.windows import rolling, series_window


def _features(spark, rows, **kw):
    df = panel_df(spark, rows).withColumn("target", F.lit(0))
    return build_features(df, keys=["Ticker"], stats="expanding", **kw).orderBy("Ticker", "Date").toPandas()


def test_feature_count_and_no_nulls(spark):
    out = _features(spark, panel_rows("A", random_walk(300, 1)))
    names = feature_names()
    assert len(names) == 132 and len(set(names)) == 132
    assert out[names].isna().sum().sum() == 0


def test_constant_series(spark):
    out = _features(spark, panel_rows("C", [50.0] * 60))
    assert (out["rsi"] == 50.0).all()
    assert (out["close_std_20"] == 0.0).all() and (out["volatility_30"] == 0.0).all()


def test_monotone_rising_rsi_100(spark):
    out = _features(spark, panel_rows("R", [10.0 + i for i in range(60)]))
    assert (out["rsi"].iloc[13:] == 100.0).all()


def test_zero_volume_then_positive(spark):
    vol = [0.0] * 5 + [100.0] * 55
    out = _features(spark, panel_rows("V", random_walk(60, 2), volumes=vol))
    # 0 -> 100 is an infinite change in pandas: NULL here, then filled forward / back
    assert out["volume_change_pct"].notna().all()


def test_ema_matches_recursion_on_long_series(spark):
    x = random_walk(3000, 3)
    df = panel_df(spark, panel_rows("E", x))
    got = with_ema(df, "Close", [9, 12, 26], "Ticker", "Date").orderBy("Date").toPandas()
    for span in (9, 12, 26):
        ref = pd.Series(x).ewm(span=span, adjust=False).mean().to_numpy()
        assert np.allclose(got[f"ema_{span}"].to_numpy(), ref, rtol=1e-12, atol=1e-9)


def test_rolling_matches_pandas(spark):
    x = random_walk(250, 4)
    df = panel_df(spark, panel_rows("W", x))
    w = series_window("Ticker", "Date")
    got = df.select("Date", rolling("Close", 20, "mean", w).alias("m"), rolling("Close", 20, "std", w).alias("s"),
                    rolling("Close", 50, "max", w).alias("mx")).orderBy("Date").toPandas()
    s = pd.Series(x)
    assert np.allclose(got["m"], s.rolling(20).mean(), equal_nan=True)
    assert np.allclose(got["s"], s.rolling(20).std(), equal_nan=True)
    assert np.allclose(got["mx"], s.rolling(50).max(), equal_nan=True)


def test_split_restart_and_train_statistic(spark):
    rows = panel_rows("A", random_walk(200, 5))
    df = panel_df(spark, rows).withColumn("target", F.lit(0))
    from tessera.operators.splits import split_by_date
    out = build_features(split_by_date(df)).toPandas()
    tr = out[out.split == "train"].sort_values("Date")
    va = out[out.split == "val"]
    # val rows carry the last train value of the expanding mean
    assert np.allclose(va["ticker_mean_return_30d"], tr["ticker_mean_return_30d"].iloc[-1])


def test_missing_close_fails_instead_of_a_wrong_average(spark):
    x = random_walk(60, 6)
    df = panel_df(spark, panel_rows("N", x[:30] + [None] + x[31:]))
    with pytest.raises(Exception, match="needs a value"):
        with_ema(df, "Close", [9], "Ticker", "Date").collect()


def test_full_fill_is_the_default(spark):
    """A missing volume inside a series: the forward fill takes the row before it."""
    vol = [100.0 + i for i in range(60)]
    vol[40] = None
    out = _features(spark, panel_rows("V", random_walk(60, 8), volumes=vol))
    assert out["volume_change"].iloc[40] == out["volume_change"].iloc[39] == 1.0


def test_shared_back_fill_equals_the_full_fill(spark):
    """Series shorter and longer than every warm-up, with a zero volume: both fills agree."""
    rows = []
    for n in (31, 95, 205, 300):
        vol = [100.0 + i % 9 for i in range(n)]
        vol[n // 2] = 0.0
        rows += panel_rows(f"S{n}", random_walk(n, n), volumes=vol)
    full, shared = _features(spark, rows), _features(spark, rows, assume_clean=True)
    pd.testing.assert_frame_equal(full, shared)


def test_rolling_levels_against_pandas(spark):
    """Every window length and function, with NULLs, short and constant series, and earlier rows."""
    import numpy as np
    import pandas as pd
    from tessera.operators.windows import with_rolling
    rng = np.random.default_rng(5)
    rows = []
    for key, n in (("a", 300), ("b", 40), ("c", 3), ("d", 250)):
        for i in range(n):
            x = 7.1 if key == "d" else float(rng.normal(1000, 1))
            rows.append((key, i, None if key == "b" and i % 17 == 5 else x, float(i % 7)))
    df = spark.createDataFrame(rows, "k string, i int, x double, z double")
    lengths = (1, 2, 3, 4, 5, 7, 16, 17, 30, 63, 64, 100, 200)
    wanted = {f"{fn}_{n}": ("x", n, fn) for n in lengths for fn in ("mean", "std", "min", "max", "sum")}
    wanted |= {"before_20": ("x", 20, "mean", 3), "z_5": ("z", 5, "mean")}
    got = with_rolling(df, wanted, "k", "i").toPandas().sort_values(["k", "i"]).reset_index(drop=True)
    assert list(got.columns) == ["k", "i", "x", "z", *wanted]
    for _, g in got.groupby("k"):
        for name, (c, n, fn, *shift) in wanted.items():
            want = getattr(g[c].rolling(n), fn)().shift(shift[0] if shift else 0)
            assert np.allclose(g[name], want, rtol=1e-12, atol=1e-7, equal_nan=True), name
            if fn in ("min", "max"):
                assert (g[name].dropna() == want.dropna()).all()
    assert (got.loc[got.k == "d", "std_200"].dropna() == 0).all()


def test_only_what_the_wanted_features_read_is_computed(spark, monkeypatch):
    from tessera.operators import features as module
    asked, whole = [], module.with_statistics
    monkeypatch.setattr(module, "with_statistics", lambda df, wanted, number: asked.append(set(wanted)) or whole(df, wanted, number))
    vol = [0.0 if i % 17 == 3 else 50.0 + i % 7 for i in range(320)]
    rows = panel_rows("A", random_walk(320, 5), volumes=vol) + panel_rows("B", random_walk(40, 6))
    full = _features(spark, rows)
    read = {"volume_price_trend": {"volume_lag_1", "_lagc1"}, "month": set(), "macd": {"__ema_fast", "__ema_slow", "macd"}}
    for name, statistics in read.items():
        asked.clear()
        got = _features(spark, rows, only=[name])
        assert asked == [statistics], name
        assert list(got.columns) == ["Ticker", "Date", "target", name]
        pd.testing.assert_series_equal(got[name], full[name])
    some = feature_names()[::3]
    pd.testing.assert_frame_equal(_features(spark, rows, only=some)[some], full[some])
