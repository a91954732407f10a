"""Queries over the feature catalogue (I1-I22, B9) and the generic windows (E*, F2).

Comparison policy: features that are exact IEEE arithmetic on input values
(lags, differences, ratios of raw values, min / max) are compared as is;
features built on aggregates (means, deviations, EMAs) or transcendental
functions are rounded identically on both sides (``DIGITS``), because two
engines may sum in a different order.  Price-level aggregates are cast to
float32 -- the reference's own sink type -- rather than rounded to decimals:
a mean of a few short-decimal prices can sit exactly on a decimal half,
never on a binary one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.scalar import rounded
from tessera.operators import windows as Wn
from tessera.operators.features import INT_FEATURES, build_features, feature_names
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import PANEL_CTES, feature_sql, with_
from tessera.plans.queries_panel import panel
from tessera.sources.bars import load_bars
from tessera.sources.tables import read_table

F32 = -1  # marker: compare as float32
DIGITS: dict[str, int] = {}
for _n in ["bb_upper", "bb_middle", "bb_lower", "macd", "macd_signal", "macd_histogram",
           "macd_price_position_interaction", "volatility_volume_interaction"] + \
        [f"volume_ma_{n}" for n in (5, 7, 10, 30)] + \
        [f"close_std_{n}" for n in (5, 10, 20)] + [f"close_mean_{n}" for n in (5, 10, 20)] + \
        [f"ma_{n}" for n in (50, 100, 200)] + [f"volatility_{n}" for n in (30, 60, 90)]:
    DIGITS[_n] = F32
# MACD values are differences of two EMAs (cancellation): an absolute grid
for _n in ["macd", "macd_signal", "macd_histogram", "macd_price_position_interaction"]:
    DIGITS[_n] = 4
DIGITS["macd_volatility_interaction"] = 2
for _n in ["rsi", "bb_width", "bb_position", "ticker_mean_return_30d", "market_regime_strength",
           "volatility_regime", "trend_strength_30", "trend_strength_60", "rsi_volume_interaction",
           "rsi_trend_interaction", "bb_position_volume_interaction", "trend_volatility_interaction",
           "volatility_ratio_30_60", "volatility_ratio_60_90"] + \
        [f"volume_to_ma_{n}" for n in (5, 7, 10, 30)] + [f"close_range_pct_{n}" for n in (5, 10, 20)] + \
        [f"close_to_ma_{n}" for n in (50, 100, 200)] + [f"ma_{n}_trend" for n in (50, 100, 200)] + \
        [f"trend_slope_{n}" for n in (30, 60, 90)] + [f"volatility_pct_{n}" for n in (30, 60, 90)]:
    DIGITS[_n] = 6
for _n in ["day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos", "day_of_month_sin",
           "day_of_month_cos"]:
    DIGITS[_n] = 9

_ALL = feature_names()
GROUPS = {
    "features_price": _ALL[0:14],
    "features_rsi": ["rsi"],
    "features_macd": ["macd", "macd_signal", "macd_histogram"],
    "features_bollinger": ["bb_upper", "bb_middle", "bb_lower", "bb_width", "bb_position"],
    "features_volume": _ALL[23:34],
    "features_lags": _ALL[34:49],
    "features_rolling": _ALL[49:67],
    "features_calendar": _ALL[67:82],
    "features_long_term": _ALL[82:115],
    "features_ticker_stat": ["ticker_mean_return_30d"],
    "features_regime": _ALL[116:124],
    "features_interactions": _ALL[124:132],
    "features_all": _ALL,
}


def _spark_col(n):
    d = DIGITS.get(n)
    if d == F32:
        return (F.col(n) + F.lit(0.0)).cast("float").alias(n)
    return rounded(n, d).alias(n) if d is not None else F.col(n)


def _sql_col(n):
    d = DIGITS.get(n)
    if d == F32:
        return f'CAST("{n}" + 0.0 AS FLOAT) AS "{n}"'
    return f'round("{n}", {d}) + 0.0 AS "{n}"' if d is not None else f'"{n}"'


def features_table(spark, sf_dir, only=None):
    """The 132 features of the panel, which P1 has just cleaned, or those of ``only``."""
    return build_features(panel(spark, sf_dir), assume_clean=True, only=only)


def _make(cols):
    def q(spark, sf_dir):
        return features_table(spark, sf_dir, cols).select("split", "Ticker", "Date", "target",
                                                          *[_spark_col(c) for c in cols])
    return q


_FEAT = with_(*PANEL_CTES, feature_sql())
for _name, _cols in GROUPS.items():
    register(_name, _FEAT + 'SELECT split, "Ticker", "Date", target, '
             + ", ".join(_sql_col(c) for c in _cols) + " FROM feat")(_make(_cols))

assert INT_FEATURES <= set(_ALL)


# ---- generic window operators over raw event rows -----------------------------

def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")


_EW = "PARTITION BY user_id ORDER BY ts, event_id"


_LAG_SQL = f"""
SELECT user_id, ts, event_id, value, value_lag1, value_lag2, value_lag3 FROM (
  SELECT user_id, ts, event_id, value,
         lag(value, 1) OVER ({_EW}) AS value_lag1, lag(value, 2) OVER ({_EW}) AS value_lag2,
         lag(value, 3) OVER ({_EW}) AS value_lag3, row_number() OVER ({_EW}) AS rn FROM events)
WHERE rn > 3"""


@register("event_lagged_matrix", _LAG_SQL)
def q_event_lagged(spark, sf_dir):
    return Wn.lagged_matrix(_events(spark, sf_dir), ["value"], [1, 2, 3], "user_id", ["ts", "event_id"])


@register("event_lagged_matrix_chunked", _LAG_SQL)
def q_event_lagged_chunked(spark, sf_dir):
    """E9 with chunks of 16 rows and a 3-row halo, so that every user spans several chunks here."""
    return Wn.lagged_matrix(_events(spark, sf_dir), ["value"], [1, 2, 3], "user_id", ["ts", "event_id"],
                            chunk_rows=16)


def _ef(n):
    return f"({_EW} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_ROLL_SQL = f"""
SELECT user_id, ts, event_id,
  round(avg(value) OVER {_ef(5)}, 6) + 0.0 AS value_mean5, round(stddev_pop(value) OVER {_ef(5)}, 6) + 0.0 AS value_std5,
  min(value) OVER {_ef(5)} AS value_min5, max(value) OVER {_ef(5)} AS value_max5,
  round(avg(value) OVER {_ef(10)}, 6) + 0.0 AS value_mean10, round(stddev_pop(value) OVER {_ef(10)}, 6) + 0.0 AS value_std10,
  min(value) OVER {_ef(10)} AS value_min10, max(value) OVER {_ef(10)} AS value_max10
FROM events"""


@register("event_rolling_matrix", _ROLL_SQL)
def q_event_rolling(spark, sf_dir):
    out = Wn.rolling_matrix(_events(spark, sf_dir), ["value"], [5, 10], ["mean", "std", "min", "max"],
                            "user_id", ["ts", "event_id"])
    return _round_rolling(out)


def _round_rolling(out):
    keep = ["user_id", "ts", "event_id"]
    return out.select(*keep, *[(F.round(c, 6) + 0.0).alias(c) if ("mean" in c or "std" in c) else F.col(c)
                               for c in out.columns if c not in keep])


@register("event_rolling_matrix_chunked", _ROLL_SQL)
def q_event_rolling_chunked(spark, sf_dir):
    """E10 with chunks of 16 rows and a 9-row halo."""
    out = Wn.rolling_matrix(_events(spark, sf_dir), ["value"], [5, 10], ["mean", "std", "min", "max"],
                            "user_id", ["ts", "event_id"], chunk_rows=16)
    return _round_rolling(out)


@register("event_expanding_mean", f"""
SELECT user_id, ts, event_id,
  round(coalesce(avg(value) OVER ({_EW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0), 9) + 0.0 AS value_expanding
FROM events""")
def q_event_expanding(spark, sf_dir):
    out = Wn.running_mean(_events(spark, sf_dir), "value", "user_id", ["ts", "event_id"])
    return out.select("user_id", "ts", "event_id", (F.round("value_expanding", 9) + 0.0).alias("value_expanding"))


@register("event_lag_lead_diff", f"""
SELECT user_id, ts, event_id, lag(value, 2) OVER ({_EW}) AS lag2, lead(value, 2) OVER ({_EW}) AS lead2,
  value - lag(value) OVER ({_EW}) AS diff1,
  CASE WHEN lag(value, 3) OVER ({_EW}) = 0 THEN NULL ELSE value / lag(value, 3) OVER ({_EW}) END - 1 AS pct3
FROM events""")
def q_event_lag_lead(spark, sf_dir):
    columns = lambda w: [Wn.lag("value", 2, w).alias("lag2"), Wn.lead("value", 2, w).alias("lead2"),
                         Wn.diff("value", w).alias("diff1"), Wn.pct_change("value", w, 3).alias("pct3")]
    return Wn.by_chunk(_events(spark, sf_dir), columns, "user_id", ["ts", "event_id"], before=3, after=2)


@register("event_fill", f"""
SELECT user_id, ts, event_id,
  coalesce(last_value(v IGNORE NULLS) OVER ({_EW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(v IGNORE NULLS) OVER ({_EW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0.0) AS value
FROM (SELECT *, CASE WHEN event_id % 4 = 0 OR event_type = 'click' THEN NULL ELSE value END AS v FROM events)""")
def q_event_fill(spark, sf_dir):
    from tessera.operators.ranges import fill
    ev = read_table(spark, sf_dir, "events")
    gappy = ev.select("user_id", "ts", "event_id",
                      F.when((F.col("event_id") % 4 == 0) | (F.col("event_type") == "click"), F.lit(None))
                      .otherwise(F.col("value")).cast("double").alias("value"))
    return fill(gappy, "value", ["user_id"], ["ts", "event_id"])


_GAPPY = "CASE WHEN event_id % 4 = 0 OR event_type = 'click' THEN NULL ELSE value END"


def _ema_step(span):
    a = f"(2.0::DOUBLE / {span + 1})"
    return f"(pow(1 - {a}, g) * e{span} + {a} * v) / (pow(1 - {a}, g) + {a}) AS e{span}"


@register("event_ema", f"""
WITH RECURSIVE ev AS (SELECT user_id, ts, event_id, {_GAPPY} AS v, row_number() OVER ({_EW}) AS pos FROM events),
ob AS (SELECT user_id, pos, v, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS k,
         pos - lag(pos) OVER (PARTITION BY user_id ORDER BY pos) AS g FROM ev WHERE v IS NOT NULL),
sc AS (SELECT user_id, pos, k, v AS e5, v AS e26 FROM ob WHERE k = 1 UNION ALL
  SELECT ob.user_id, ob.pos, ob.k, {_ema_step(5)}, {_ema_step(26)}
  FROM sc JOIN ob ON ob.user_id = sc.user_id AND ob.k = sc.k + 1)
SELECT user_id, ts, event_id, v AS value,
  round(last_value(e5 IGNORE NULLS) OVER up_to, 9) + 0.0 AS ema_5, round(last_value(e26 IGNORE NULLS) OVER up_to, 9) + 0.0 AS ema_26
FROM ev LEFT JOIN sc USING (user_id, pos)
WINDOW up_to AS ({_EW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_event_ema(spark, sf_dir):
    """E7 on raw rows with gaps."""
    from tessera.operators.ema import running_ema
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.expr(_GAPPY).alias("value"))
    out = running_ema(ev, "value", [5, 26], "user_id", ["ts", "event_id"])
    return out.select("user_id", "ts", "event_id", "value",
                      *[(F.round(c, 9) + 0.0).alias(c) for c in ("ema_5", "ema_26")])


def _rolling_median(rows):
    return rows[["user_id", "ts", "event_id"]].assign(median=rows["value"].rolling(7, min_periods=1).median())


@register("event_series_function", f"""
SELECT user_id, ts, event_id, round(median(value) OVER {_ef(7)}, 6) + 0.0 AS median FROM events""")
def q_event_function(spark, sf_dir):
    """O2: a median over the last seven rows, a function Spark has no window form of at a bounded cost."""
    out = Wn.apply_per_series(_events(spark, sf_dir), _rolling_median,
                              "user_id long, ts timestamp, event_id long, median double",
                              "user_id", ["ts", "event_id"], before=6)
    return out.select("user_id", "ts", "event_id", (F.round("median", 6) + 0.0).alias("median"))


@register("last_rows_per_series", with_(PANEL_CTES[0]) + """
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS r FROM bars)
WHERE r <= 250""")
def q_last_rows(spark, sf_dir):
    return Wn.last_n_rows(load_bars(spark, sf_dir), 250)


# ---- D3 + C2: the train statistic as a lookup table ----------------------------

@register("train_statistic_lookup", _FEAT + """, st AS (
  SELECT "Ticker", arg_max(ticker_mean_return_30d, "Date") AS stat FROM feat WHERE split = 'train' GROUP BY "Ticker")
SELECT f.split, f."Ticker", f."Date", round(coalesce(st.stat, 0.0), 6) + 0.0 AS ticker_mean_return_30d
FROM feat f LEFT JOIN st USING ("Ticker") WHERE f.split <> 'train'""")
def q_train_stat_lookup(spark, sf_dir):
    """D3 (last train value per series) joined back to val / test rows (C2,
    default 0) -- the table form of what the feature window computes."""
    from tessera.operators.features import lookup_statistic, train_statistic
    f = features_table(spark, sf_dir, ["ticker_mean_return_30d"])
    stats = train_statistic(f)
    rows = f.where(F.col("split") != "train").select("split", "Ticker", "Date")
    out = lookup_statistic(rows.withColumn("ticker_mean_return_30d", F.lit(0.0)), stats)
    return out.select("split", "Ticker", "Date", _spark_col("ticker_mean_return_30d"))
