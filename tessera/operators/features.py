"""The feature catalogue (I1-I22) and its cleanup.

``build_features`` turns a panel (series key, Date, OHLCV[, target, split])
into the 132 feature columns.  Plan shape, for any number of series:

    panel (already clustered by series)
      -> Windows A, B (changes, month marks, expanding)   all on one partition / order spec
      -> one pass over arrays of whole series: EMA, rolling statistics, lags (``series``)
      -> projection (ratios, regimes, interactions)
      -> one pass for the fill: ffill / first valid / 0

All windows share ``partitionBy(keys).orderBy(Date)``, the only shuffle; the passes read
their sorted rows batch by batch.  Features of each split restart at the split start when
``keys`` includes ``split`` (the reference computes every split on its own).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import eps_div, flag, safe_div
from tessera.operators.ema import averaged, macd_statistics
from tessera.operators.series import filled, filled_cells, with_statistics
from tessera.operators.windows import (expanding_mean, pct_change, position_in_month_finish,
                                       running_position_in_month, series_window)

# Window lengths and lags of the catalogue.
RETURN_DAYS = (1, 3, 5, 10)
VOLUME_MA = (5, 7, 10, 30)
LAGS = (1, 2, 3, 5, 10)
SHORT_ROLL = (5, 10, 20)
LONG_MA = (50, 100, 200)
TREND = (30, 60, 90)
LONG_RETURNS = (30, 60, 90)
RSI_WINDOW = 14
BB_WINDOW, BB_STD = 20, 2
YEAR_LAG = 252


def feature_names() -> list[str]:
    """The 132 feature columns, in the reference's order."""
    n = ["price_change", "price_change_pct", "high_low_spread", "high_low_spread_pct",
         "open_close_diff", "open_close_diff_pct"]
    for d in RETURN_DAYS:
        n += [f"return_{d}d", f"return_{d}d_abs"]
    n += ["rsi", "macd", "macd_signal", "macd_histogram",
          "bb_upper", "bb_middle", "bb_lower", "bb_width", "bb_position"]
    for w in VOLUME_MA:
        n += [f"volume_ma_{w}", f"volume_to_ma_{w}"]
    n += ["volume_change", "volume_change_pct", "volume_price_trend"]
    for k in LAGS:
        n += [f"close_lag_{k}", f"close_lag_{k}_pct", f"volume_lag_{k}"]
    for w in SHORT_ROLL:
        n += [f"close_std_{w}", f"close_mean_{w}", f"close_min_{w}", f"close_max_{w}",
              f"close_range_{w}", f"close_range_pct_{w}"]
    n += ["day_of_week", "day_of_month", "month", "quarter", "year",
          "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
          "day_of_month_sin", "day_of_month_cos",
          "days_since_month_start", "days_until_month_end", "is_month_start", "is_month_end",
          "year_ago_return"]
    for w in LONG_MA:
        n += [f"ma_{w}", f"close_to_ma_{w}", f"ma_{w}_trend"]
    n += [f"trend_slope_{w}" for w in TREND]
    for w in TREND:
        n += [f"volatility_{w}", f"volatility_pct_{w}"]
    n += ["volatility_ratio_30_60", "volatility_ratio_60_90"]
    for w in LONG_MA:
        n += [f"price_min_{w}", f"price_max_{w}", f"price_position_{w}"]
    n += [f"return_{d}d" for d in LONG_RETURNS]
    n += ["ticker_mean_return_30d",
          "is_bull_market", "is_bear_market", "market_regime_strength",
          "is_high_volatility", "volatility_regime",
          "trend_strength_30", "trend_strength_60", "trend_direction",
          "rsi_volume_interaction", "macd_volatility_interaction",
          "momentum_volume_interaction", "rsi_trend_interaction",
          "macd_price_position_interaction", "volatility_volume_interaction",
          "bb_position_volume_interaction", "trend_volatility_interaction"]
    return n


# Columns that can never be NULL (calendar parts and 0/1 flags): no fill pass.
NEVER_NULL = {"day_of_week", "day_of_month", "month", "quarter", "year",
              "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
              "day_of_month_sin", "day_of_month_cos", "days_since_month_start",
              "days_until_month_end", "is_month_start", "is_month_end",
              "is_bull_market", "is_bear_market", "is_high_volatility", "trend_direction",
              "ticker_mean_return_30d"}

INT_FEATURES = {"day_of_week", "day_of_month", "month", "quarter", "year",
                "days_since_month_start", "days_until_month_end", "is_month_start",
                "is_month_end", "is_bull_market", "is_bear_market", "is_high_volatility",
                "trend_direction"}


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def build_features(panel: DataFrame, keys=("split", "Ticker"), order: str = "Date",
                   stats: str = "train", clean: bool = True, causal_fill: bool = False,
                   keep: tuple = ("target",), assume_clean: bool = False, only: Sequence[str] | None = None,
                   each: tuple | None = None) -> DataFrame:
    """Feature table: key columns, ``keep`` columns that exist, then the 132 features, or
    those of ``only``, for which no other statistic is computed.

    ``stats`` chooses ``ticker_mean_return_30d``: ``"train"`` -- expanding
    mean on train rows, and for other splits the train value of the series
    (the last expanding mean = the mean over all its train rows);
    ``"expanding"`` -- expanding mean everywhere (scoring path).
    ``causal_fill=True`` replaces the back fill of the cleanup by 0 (no
    look-ahead at a series start).  Every feature gets the full fill, whether or
    not the panel has just gone through ``handle_missing_values`` (``assume_clean``).
    A NULL close fails the job (``ema.averaged``): fill it first.
    ``each`` = (columns, fn, schema, others) returns what ``fn`` makes of the filled features in
    each task instead (``series.filled_cells``).
    """
    out_keys = _list(keys)
    series = [k for k in out_keys if k != "split"]
    # the series first: rows in order of (series, split, date) serve its window over all splits unsorted
    keys = series + [k for k in out_keys if k == "split"]
    w = series_window(keys, order)
    base = panel.select(*keys, order, *[c for c in keep if c in panel.columns], "Open", "High", "Low", "Close", "Volume")

    # ---- Window A, on few columns: changes, 30-row returns, month marks ----
    delta = F.col("Close") - F.lag("Close", 1).over(w)
    mark, rn = running_position_in_month(order, w)
    s0 = base.withColumns({"price_change": delta, "_pct30": pct_change(F.col("Close"), w, 30), "_month_mark": mark, "_rn": rn})
    delta = F.col("price_change")
    ret30 = F.col("_pct30")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if stats == "train" and "split" in keys:
        train_mean = F.avg(F.when(F.col("split") == "train", ret30)).over(Window.partitionBy(*series))
        statistic = F.coalesce(F.when(F.col("split") == "train", F.avg(ret30).over(running)).otherwise(train_mean),
                               F.lit(0.0))
    else:
        statistic = expanding_mean(ret30, w)
    # ---- Window B: windows over window outputs ----
    s0 = s0.withColumns({
        "days_since_month_start": position_in_month_finish("_month_mark", "_rn", w), "ticker_mean_return_30d": statistic,
        "_gain": F.coalesce(F.when(delta > 0, delta).otherwise(F.lit(0.0)), F.lit(0.0)),
        "_loss": F.coalesce(F.when(delta < 0, -delta).otherwise(F.lit(0.0)), F.lit(0.0))}).drop("_month_mark")

    # ---- moving averages, rolling statistics and plain lags: one pass over arrays of whole series ----
    a: dict[str, tuple] = macd_statistics("_close")
    for k in sorted(set(RETURN_DAYS + LAGS + LONG_RETURNS + (YEAR_LAG,) + tuple(n - 1 for n in TREND)) - {30}):
        a[f"_lagc{k}"] = ("Close", k, "lag")
    for k in LAGS:
        a[f"volume_lag_{k}"] = ("Volume", k, "lag")
    a |= {"_avg_gain": ("_gain", RSI_WINDOW, "mean"), "_avg_loss": ("_loss", RSI_WINDOW, "mean")}
    a |= {f"volume_ma_{n}": ("Volume", n, "mean") for n in VOLUME_MA}
    a |= {f"_mean{n}": ("Close", n, "mean") for n in sorted(set(SHORT_ROLL + LONG_MA + TREND))}
    a |= {f"_before{n}": ("Close", n, "mean", 1) for n in LONG_MA}
    a |= {f"_std{n}": ("Close", n, "std") for n in sorted(set(SHORT_ROLL + TREND))}
    a |= {f"_{fn}{n}": ("Close", n, fn) for n in sorted(set(SHORT_ROLL + LONG_MA)) for fn in ("min", "max")}
    # ---- projection: ratios, calendar, regimes, interactions ---------------
    # each feature is a function, called only if it is wanted, so that the columns it reads are known
    read: set[str] = set()

    def col(name: str) -> Column:
        read.add(name)
        return F.col(name)

    C, H, L, O, V = ((lambda c=c: col(c)) for c in ("Close", "High", "Low", "Open", "Volume"))

    def pct(k: int) -> Column:
        return col("_pct30") if k == 30 else safe_div(C(), col(f"_lagc{k}")) - F.lit(1.0)

    f: dict[str, Callable[[], Column]] = {}
    f["price_change"] = lambda: col("price_change")
    f["price_change_pct"] = lambda: pct(1)
    f["high_low_spread"] = lambda: H() - L()
    f["high_low_spread_pct"] = lambda: eps_div(H() - L(), C())
    f["open_close_diff"] = lambda: C() - O()
    f["open_close_diff_pct"] = lambda: eps_div(C() - O(), O())
    for d in RETURN_DAYS:
        f[f"return_{d}d"] = lambda d=d: pct(d)
        f[f"return_{d}d_abs"] = lambda d=d: F.abs(pct(d))

    def rsi() -> Column:
        g, lo = col("_avg_gain"), col("_avg_loss")
        return (F.when(g.isNull() | lo.isNull(), F.lit(50.0))
                .when(lo == 0, F.when(g > 0, F.lit(100.0)).otherwise(F.lit(50.0)))
                .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / lo)))
    f["rsi"] = rsi
    for c in ("macd", "macd_signal", "macd_histogram"):
        f[c] = lambda c=c: col(c)
    m20 = lambda: col(f"_mean{BB_WINDOW}")
    upper = lambda: m20() + col(f"_std{BB_WINDOW}") * BB_STD
    lower = lambda: m20() - col(f"_std{BB_WINDOW}") * BB_STD
    f["bb_upper"], f["bb_middle"], f["bb_lower"] = upper, m20, lower
    f["bb_width"] = lambda: eps_div(upper() - lower(), m20())
    f["bb_position"] = lambda: eps_div(C() - lower(), upper() - lower())
    for n in VOLUME_MA:
        f[f"volume_ma_{n}"] = lambda n=n: col(f"volume_ma_{n}")
        f[f"volume_to_ma_{n}"] = lambda n=n: eps_div(V(), col(f"volume_ma_{n}"))
    f["volume_change"] = lambda: V() - col("volume_lag_1")
    f["volume_change_pct"] = lambda: safe_div(V(), col("volume_lag_1")) - F.lit(1.0)
    f["volume_price_trend"] = lambda: f["volume_change_pct"]() * pct(1)
    for k in LAGS:
        f[f"close_lag_{k}"] = lambda k=k: col(f"_lagc{k}")
        f[f"close_lag_{k}_pct"] = lambda k=k: pct(k)
        f[f"volume_lag_{k}"] = lambda k=k: col(f"volume_lag_{k}")
    for n in SHORT_ROLL:
        f[f"close_std_{n}"] = lambda n=n: col(f"_std{n}")
        f[f"close_mean_{n}"] = lambda n=n: col(f"_mean{n}")
        f[f"close_min_{n}"] = lambda n=n: col(f"_min{n}")
        f[f"close_max_{n}"] = lambda n=n: col(f"_max{n}")
        f[f"close_range_{n}"] = lambda n=n: col(f"_max{n}") - col(f"_min{n}")
        f[f"close_range_pct_{n}"] = lambda n=n: eps_div(col(f"_max{n}") - col(f"_min{n}"), col(f"_mean{n}"))
    date = F.col(order)
    dow, dom, mon = F.weekday(date), F.dayofmonth(date), F.month(date)
    two_pi = F.lit(2 * math.pi)
    calendar = {"day_of_week": dow, "day_of_month": dom, "month": mon, "quarter": F.quarter(date), "year": F.year(date),
                "days_until_month_end": F.lit(31) - dom, "is_month_start": (dom <= 3).cast("int"),
                "is_month_end": (dom >= 28).cast("int")}
    for name, x, period in (("day_of_week", dow, 7.0), ("month", mon, 12.0), ("day_of_month", dom, 31.0)):
        calendar[f"{name}_sin"] = F.sin(two_pi * x / F.lit(period))
        calendar[f"{name}_cos"] = F.cos(two_pi * x / F.lit(period))
    for name, x in calendar.items():
        f[name] = lambda x=x: x
    f["days_since_month_start"] = lambda: col("days_since_month_start").cast("int")
    f["year_ago_return"] = lambda: pct(YEAR_LAG)
    for n in LONG_MA:
        f[f"ma_{n}"] = lambda n=n: col(f"_mean{n}")
        f[f"close_to_ma_{n}"] = lambda n=n: eps_div(C(), col(f"_mean{n}")) - F.lit(1.0)
        f[f"ma_{n}_trend"] = lambda n=n: eps_div(col(f"_mean{n}") - col(f"_before{n}"), col(f"_mean{n}"))
    for n in TREND:
        f[f"trend_slope_{n}"] = lambda n=n: eps_div(C() - col(f"_lagc{n - 1}"), col(f"_mean{n}") * F.lit(float(n)))
    for n in TREND:
        f[f"volatility_{n}"] = lambda n=n: col(f"_std{n}")
        f[f"volatility_pct_{n}"] = lambda n=n: eps_div(col(f"_std{n}"), C())
    f["volatility_ratio_30_60"] = lambda: eps_div(col("_std30"), col("_std60"))
    f["volatility_ratio_60_90"] = lambda: eps_div(col("_std60"), col("_std90"))
    for n in LONG_MA:
        f[f"price_min_{n}"], f[f"price_max_{n}"] = (lambda n=n: col(f"_min{n}")), (lambda n=n: col(f"_max{n}"))
        f[f"price_position_{n}"] = lambda n=n: eps_div(C() - col(f"_min{n}"), col(f"_max{n}") - col(f"_min{n}"))
    for d in LONG_RETURNS:
        f[f"return_{d}d"] = lambda d=d: pct(d)
    f["ticker_mean_return_30d"] = lambda: col("ticker_mean_return_30d")
    f["is_bull_market"] = lambda: flag(C() > col("_mean200"))
    f["is_bear_market"] = lambda: flag(C() < col("_mean200"))
    f["market_regime_strength"] = lambda: F.abs(f["close_to_ma_200"]())
    f["is_high_volatility"] = lambda: flag(col("_std30") > col("_std60"))
    f["volatility_regime"] = f["volatility_ratio_30_60"]
    f["trend_strength_30"] = lambda: F.abs(f["trend_slope_30"]())
    f["trend_strength_60"] = lambda: F.abs(f["trend_slope_60"]())
    f["trend_direction"] = lambda: F.signum(F.coalesce(f["trend_slope_30"](), F.lit(0.0))).cast("int")
    for name, one, other in (("rsi_volume", "rsi", "volume_to_ma_10"), ("macd_volatility", "macd", "volatility_30"),
                             ("momentum_volume", "return_10d", "volume_change_pct"), ("rsi_trend", "rsi", "trend_slope_30"),
                             ("macd_price_position", "macd", "price_position_100"),
                             ("volatility_volume", "volatility_30", "volume_to_ma_10"),
                             ("bb_position_volume", "bb_position", "volume_to_ma_10"),
                             ("trend_volatility", "trend_slope_30", "volatility_30")):
        f[f"{name}_interaction"] = lambda one=one, other=other: f[one]() * f[other]()

    names = feature_names()
    assert len(names) == 132 and set(names) == set(f), set(f) ^ set(names)
    names = names if only is None else [n for n in names if n in set(only)]
    wanted = [f[n]().alias(n) for n in names]
    # only the statistics that the wanted features read, and what those are made of
    for name, spec in reversed(a.items()):
        if name in read:
            read.update(c for c in spec[:2] if isinstance(c, str))
    s0 = s0.withColumn("_close", averaged("Close"))
    kept = {*out_keys, order, *keep, "_rn", "_close"} | read
    s2 = with_statistics(s0.select(*[c for c in s0.columns if c in kept]), {n: x for n, x in a.items() if n in read}, "_rn")
    front = [F.col(c) for c in out_keys + [order] + [c for c in keep if c in panel.columns]]
    feats = s2.select(*front, *wanted, "_rn")
    if each is not None:
        columns, fn, schema, others = each
        return filled_cells(feats, columns, "_rn", fn, schema, others, back=not causal_fill)
    if clean:
        feats = cleanup(feats, names, "_rn", causal=causal_fill)
    return feats.drop("_rn")


def feature_cells(panel: DataFrame, **parameters):
    """The features of ``panel`` for ``series.over_cells``: computed, filled and handed to a function of arrays in
    one pass, without becoming rows again."""
    def over(columns, fn, schema, others=()):
        return build_features(panel, only=columns, each=(columns, fn, schema, others), **parameters)
    return over


def cleanup(df: DataFrame, features, number: str, causal: bool = False) -> DataFrame:
    """Per series forward fill, then back fill, then 0.

    The back fill equals the first valid value of the whole ordered series
    (only a leading NULL run survives a forward fill).  ``causal=True`` fills
    that leading run with 0 instead.  ``number`` is the row's number in its series.
    """
    return filled(df, [c for c in features if c not in NEVER_NULL], number, back=not causal)


def train_statistic(features: DataFrame, column: str = "ticker_mean_return_30d",
                    series: str = "Ticker", order: str = "Date") -> DataFrame:
    """D3: last train value of ``column`` per series (the val/test lookup table)."""
    return (features.where(F.col("split") == "train").groupBy(series)
            .agg(F.max_by(column, order).alias(column)))


def lookup_statistic(df: DataFrame, stats: DataFrame, column: str = "ticker_mean_return_30d",
                     series: str = "Ticker") -> DataFrame:
    """Left lookup of a per-series statistic, 0 when the series is unknown.

    No broadcast hint: the statistic has one row per series, which grows
    with the panel; Spark broadcasts it by itself when it is small.
    """
    s = stats.select(series, F.col(column).alias("_stat"))
    return (df.drop(column).join(s, series, "left")
            .withColumn(column, F.coalesce(F.col("_stat"), F.lit(0.0))).drop("_stat"))
