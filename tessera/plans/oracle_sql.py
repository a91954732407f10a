"""Independent DuckDB SQL for each registered query.

Written by hand against the driver's pre-registered views; shared CTEs are
plain SQL text composed with ``with_(...)``.  Column names and types follow
the Spark queries (counts BIGINT, flags INTEGER, measures DOUBLE).
"""

from __future__ import annotations

import re

# ---- shared CTEs -------------------------------------------------------------

BARS = """bars AS (
  SELECT "Date", "Ticker",
         arg_min(p, (ok, ln, p)) AS "Open", max(p) AS "High", min(p) AS "Low",
         arg_max(p, (ok, ln, p)) AS "Close", sum(q) AS "Volume",
         0.0::DOUBLE AS "Dividends", 0.0::DOUBLE AS "Stock Splits"
  FROM (SELECT CAST(l_suppkey AS VARCHAR) AS "Ticker", CAST(l_shipdate AS DATE) AS "Date",
               l_extendedprice / l_quantity AS p, l_quantity AS q,
               l_orderkey AS ok, l_linenumber AS ln FROM lineitem) l
  GROUP BY "Ticker", "Date")"""

GAPPY = """gappy AS (
  SELECT "Date", "Ticker",
         CASE WHEN (day("Date") = 11 OR day("Date") = 22) AND month("Date") % 4 = 0 THEN 0.0
              ELSE "Open" END AS "Open",
         "High", "Low",
         CASE WHEN day("Date") % 7 = 0 THEN NULL ELSE "Close" END AS "Close",
         CASE WHEN day("Date") % 5 = 0 THEN NULL ELSE "Volume" END AS "Volume",
         CASE WHEN day("Date") % 3 = 0 THEN NULL ELSE "Dividends" END AS "Dividends",
         "Stock Splits"
  FROM bars)"""


def _fill(c: str) -> str:
    return (f'coalesce(last_value("{c}" IGNORE NULLS) OVER wr, '
            f'first_value("{c}" IGNORE NULLS) OVER wa, 0.0) AS "{c}"')


def clean_cte(source: str) -> str:
    return f"""filled AS (
  SELECT "Date", "Ticker", {_fill("Open")}, {_fill("High")}, {_fill("Low")}, {_fill("Close")},
         {_fill("Volume")}, coalesce("Dividends", 0.0) AS "Dividends",
         coalesce("Stock Splits", 0.0) AS "Stock Splits"
  FROM {source}
  WINDOW wr AS (PARTITION BY "Ticker" ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wa AS (PARTITION BY "Ticker" ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
valid AS (SELECT * FROM filled WHERE "Open" > 0 AND "High" > 0 AND "Low" > 0 AND "Close" > 0),
clean AS (SELECT * EXCLUDE (n_rows) FROM
  (SELECT *, count(*) OVER (PARTITION BY "Ticker") AS n_rows FROM valid) WHERE n_rows >= 31)"""


CLEAN = clean_cte("gappy")          # only the queries on cleaning read the gappy bars

LABELLED = """labelled AS (
  SELECT * EXCLUDE (fut), CAST(fut > "Close" AS INTEGER) AS target FROM
  (SELECT *, lead("Close", 30) OVER (PARTITION BY "Ticker" ORDER BY "Date") AS fut FROM clean)
  WHERE fut IS NOT NULL)"""

SPLIT = """split_dates AS (
  SELECT "Date",
         CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
              WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT "Date", row_number() OVER (ORDER BY "Date") - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT "Date" FROM labelled))),
panel AS (SELECT l.*, s.split FROM labelled l JOIN split_dates s USING ("Date"))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PANEL_CTES = (BARS, clean_cte("bars"), LABELLED, SPLIT)


# ---- feature catalogue (I1-I22, B9) in DuckDB ---------------------------------

_W = 'PARTITION BY split, "Ticker" ORDER BY "Date"'


def _sd(a: str, b: str) -> str:
    """Division that is NULL on a zero divisor (pandas: inf / NaN -> filled later)."""
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


def _ed(a: str, b: str) -> str:
    return _sd(a, f"({b}) + 1e-8")


def _frame(n: int) -> str:
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _roll(x: str, n: int, fn: str) -> str:
    return f"CASE WHEN count({x}) OVER {_frame(n)} >= {n} THEN {fn}({x}) OVER {_frame(n)} END"


def _pct(x: str, k: int) -> str:
    return f"{_sd(x, f'lag({x}, {k}) OVER ({_W})')} - 1"


def _ema(x: str, span: int) -> str:
    a = 2.0 / (span + 1.0)
    return (f"list_reduce(list({x}) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"lambda acc, v: acc * {1.0 - a!r} + {a!r} * v)")


# Integer features: calendar parts and flags, which are never missing.
_WHOLE = {"day_of_week", "day_of_month", "month", "quarter", "year", "days_since_month_start", "days_until_month_end",
          "is_month_start", "is_month_end", "is_bull_market", "is_bear_market", "is_high_volatility",
          "trend_direction"}


def feature_sql(source: str = "panel", tag: str = "") -> str:
    """CTEs ``fe1 .. feat`` (names led by ``tag``) over ``source``: 132 cleaned features per row."""
    sql = _feature_sql().replace("FROM panel)", f"FROM {source})")
    return re.sub(r"\b(fe[1-6]|feat)\b", tag + r"\1", sql)


def _feature_sql() -> str:
    import math
    C = '"Close"'
    e = [f'{_ema(C, 12)} AS ema12', f'{_ema(C, 26)} AS ema26']
    fe1 = f"""fe1 AS (SELECT split, "Ticker", "Date", target, "Open", "High", "Low", "Close", "Volume",
  {", ".join(e)} FROM panel)"""
    fe2 = f"""fe2 AS (SELECT *, ema12 - ema26 AS macd FROM fe1)"""
    fe3 = f"""fe3 AS (SELECT *, {_ema('macd', 9)} AS macd_signal FROM fe2)"""
    a = []
    a.append(f'{C} - lag({C}) OVER ({_W}) AS delta')
    for k in (1, 2, 3, 5, 10, 30, 60, 90, 252):
        a.append(f"{_pct(C, k)} AS p{k}")
    for k in (1, 2, 3, 5, 10):
        a.append(f'lag({C}, {k}) OVER ({_W}) AS close_lag_{k}')
        a.append(f'lag("Volume", {k}) OVER ({_W}) AS volume_lag_{k}')
    for k in (29, 59, 89):
        a.append(f'lag({C}, {k}) OVER ({_W}) AS lc{k}')
    a.append(f'"Volume" - lag("Volume") OVER ({_W}) AS volume_change')
    a.append(f'{_pct(chr(34) + "Volume" + chr(34), 1)} AS volume_change_pct')
    for n in (5, 7, 10, 30):
        a.append(f'{_roll(chr(34) + "Volume" + chr(34), n, "avg")} AS volume_ma_{n}')
    for n in (5, 10, 20, 30, 50, 60, 90, 100, 200):
        a.append(f"{_roll(C, n, 'avg')} AS m{n}")
    for n in (5, 10, 20, 30, 60, 90):
        a.append(f"{_roll(C, n, 'stddev_samp')} AS s{n}")
    for n in (5, 10, 20, 50, 100, 200):
        a.append(f"{_roll(C, n, 'min')} AS lo{n}")
        a.append(f"{_roll(C, n, 'max')} AS hi{n}")
    a.append(f"""row_number() OVER (PARTITION BY split, "Ticker", date_trunc('month', "Date")
       ORDER BY "Date") AS days_since_month_start""")
    fe4 = f"fe4 AS (SELECT *, {', '.join(a)} FROM fe3)"
    g = "CASE WHEN delta > 0 THEN delta ELSE 0.0 END"
    lo = "CASE WHEN delta < 0 THEN -delta ELSE 0.0 END"
    b = [f"{_roll(f'({g})', 14, 'avg')} AS avg_gain", f"{_roll(f'({lo})', 14, 'avg')} AS avg_loss"]
    for n in (50, 100, 200):
        b.append(f"m{n} - lag(m{n}) OVER ({_W}) AS md{n}")
    b.append(f"""coalesce(CASE WHEN split = 'train'
        THEN avg(p30) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        ELSE avg(CASE WHEN split = 'train' THEN p30 END) OVER (PARTITION BY "Ticker") END, 0.0)
        AS ticker_mean_return_30d""")
    fe5 = f"fe5 AS (SELECT *, {', '.join(b)} FROM fe4)"
    two_pi = repr(2 * math.pi)
    dow = 'CAST(isodow("Date") - 1 AS INTEGER)'
    dom = 'CAST(day("Date") AS INTEGER)'
    mon = 'CAST(month("Date") AS INTEGER)'
    f = {
        "price_change": "delta", "price_change_pct": "p1",
        "high_low_spread": '"High" - "Low"', "high_low_spread_pct": _ed('"High" - "Low"', C),
        "open_close_diff": f'{C} - "Open"', "open_close_diff_pct": _ed(f'{C} - "Open"', '"Open"'),
    }
    for d in (1, 3, 5, 10):
        f[f"return_{d}d"] = f"p{d}"
        f[f"return_{d}d_abs"] = f"abs(p{d})"
    f["rsi"] = ("CASE WHEN avg_gain IS NULL OR avg_loss IS NULL THEN 50.0 "
                "WHEN avg_loss = 0 THEN CASE WHEN avg_gain > 0 THEN 100.0 ELSE 50.0 END "
                "ELSE 100.0 - 100.0 / (1.0 + avg_gain / avg_loss) END")
    f["macd"], f["macd_signal"], f["macd_histogram"] = "macd", "macd_signal", "macd - macd_signal"
    f["bb_upper"], f["bb_middle"], f["bb_lower"] = "m20 + s20 * 2", "m20", "m20 - s20 * 2"
    f["bb_width"] = _ed("(m20 + s20 * 2) - (m20 - s20 * 2)", "m20")
    f["bb_position"] = _ed(f"{C} - (m20 - s20 * 2)", "(m20 + s20 * 2) - (m20 - s20 * 2)")
    for n in (5, 7, 10, 30):
        f[f"volume_ma_{n}"] = f"volume_ma_{n}"
        f[f"volume_to_ma_{n}"] = _ed('"Volume"', f"volume_ma_{n}")
    f["volume_change"], f["volume_change_pct"] = "volume_change", "volume_change_pct"
    f["volume_price_trend"] = "volume_change_pct * p1"
    for k in (1, 2, 3, 5, 10):
        f[f"close_lag_{k}"], f[f"close_lag_{k}_pct"], f[f"volume_lag_{k}"] = f"close_lag_{k}", f"p{k}", f"volume_lag_{k}"
    for n in (5, 10, 20):
        f[f"close_std_{n}"], f[f"close_mean_{n}"] = f"s{n}", f"m{n}"
        f[f"close_min_{n}"], f[f"close_max_{n}"] = f"lo{n}", f"hi{n}"
        f[f"close_range_{n}"] = f"hi{n} - lo{n}"
        f[f"close_range_pct_{n}"] = _ed(f"hi{n} - lo{n}", f"m{n}")
    f["day_of_week"], f["day_of_month"], f["month"] = dow, dom, mon
    f["quarter"], f["year"] = 'CAST(quarter("Date") AS INTEGER)', 'CAST(year("Date") AS INTEGER)'
    for name, x, per in (("day_of_week", dow, 7.0), ("month", mon, 12.0), ("day_of_month", dom, 31.0)):
        f[f"{name}_sin"] = f"sin({two_pi} * {x} / {per!r}::DOUBLE)"
        f[f"{name}_cos"] = f"cos({two_pi} * {x} / {per!r}::DOUBLE)"
    f["days_since_month_start"] = "CAST(days_since_month_start AS INTEGER)"
    f["days_until_month_end"] = f"31 - {dom}"
    f["is_month_start"] = f"CAST({dom} <= 3 AS INTEGER)"
    f["is_month_end"] = f"CAST({dom} >= 28 AS INTEGER)"
    f["year_ago_return"] = "p252"
    for n in (50, 100, 200):
        f[f"ma_{n}"] = f"m{n}"
        f[f"close_to_ma_{n}"] = f"{_ed(C, f'm{n}')} - 1"
        f[f"ma_{n}_trend"] = _ed(f"md{n}", f"m{n}")
    for n in (30, 60, 90):
        f[f"trend_slope_{n}"] = _ed(f"{C} - lc{n - 1}", f"m{n} * {n}.0")
    for n in (30, 60, 90):
        f[f"volatility_{n}"] = f"s{n}"
        f[f"volatility_pct_{n}"] = _ed(f"s{n}", C)
    f["volatility_ratio_30_60"] = _ed("s30", "s60")
    f["volatility_ratio_60_90"] = _ed("s60", "s90")
    for n in (50, 100, 200):
        f[f"price_min_{n}"], f[f"price_max_{n}"] = f"lo{n}", f"hi{n}"
        f[f"price_position_{n}"] = _ed(f"{C} - lo{n}", f"hi{n} - lo{n}")
    for d in (30, 60, 90):
        f[f"return_{d}d"] = f"p{d}"
    f["ticker_mean_return_30d"] = "ticker_mean_return_30d"
    f["is_bull_market"] = f"coalesce(CAST({C} > m200 AS INTEGER), 0)"
    f["is_bear_market"] = f"coalesce(CAST({C} < m200 AS INTEGER), 0)"
    f["market_regime_strength"] = f"abs({f['close_to_ma_200']})"
    f["is_high_volatility"] = "coalesce(CAST(s30 > s60 AS INTEGER), 0)"
    f["volatility_regime"] = f["volatility_ratio_30_60"]
    f["trend_strength_30"] = f"abs({f['trend_slope_30']})"
    f["trend_strength_60"] = f"abs({f['trend_slope_60']})"
    f["trend_direction"] = f"CAST(sign(coalesce({f['trend_slope_30']}, 0.0)) AS INTEGER)"
    f["rsi_volume_interaction"] = f"({f['rsi']}) * ({f['volume_to_ma_10']})"
    f["macd_volatility_interaction"] = "macd * s30"
    f["momentum_volume_interaction"] = "p10 * volume_change_pct"
    f["rsi_trend_interaction"] = f"({f['rsi']}) * ({f['trend_slope_30']})"
    f["macd_price_position_interaction"] = f"macd * ({f['price_position_100']})"
    f["volatility_volume_interaction"] = f"s30 * ({f['volume_to_ma_10']})"
    f["bb_position_volume_interaction"] = f"({f['bb_position']}) * ({f['volume_to_ma_10']})"
    f["trend_volatility_interaction"] = f"({f['trend_slope_30']}) * s30"
    names = list(f)
    assert len(names) == 132
    fe6 = "fe6 AS (SELECT split, \"Ticker\", \"Date\", target, " + ", ".join(
        f'{f[n]} AS "{n}"' for n in names) + " FROM fe5)"
    wr = f"({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wa = f"({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    cl = []
    for n in names:
        if n in _WHOLE:
            cl.append(f'"{n}"')
        else:
            cl.append(f'coalesce(last_value("{n}" IGNORE NULLS) OVER {wr}, '
                      f'first_value("{n}" IGNORE NULLS) OVER {wa}, 0.0) AS "{n}"')
    feat = "feat AS (SELECT split, \"Ticker\", \"Date\", target, " + ", ".join(cl) + " FROM fe6)"
    return ",\n".join([fe1, fe2, fe3, fe4, fe5, fe6, feat])
