"""Queries over fixed-length sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import sequences as Q
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import BARS, PANEL_CTES, with_
from tessera.plans.queries_panel import panel
from tessera.sources.bars import load_bars
from tessera.sources.tables import read_table

OHLCV = ["Open", "High", "Low", "Close", "Volume"]
L = 20  # fixed value: sequence length
_SW = 'PARTITION BY split, "Ticker" ORDER BY "Date"'
_SEQ = f"""seq AS (SELECT * EXCLUDE (rn) FROM (
  SELECT split, "Ticker", "Date",
         list(["Open", "High", "Low", "Close", "Volume"]) OVER ({_SW} ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW) AS "X",
         CAST(target AS DOUBLE) AS y, row_number() OVER ({_SW}) AS rn FROM panel) WHERE rn >= {L})"""


def sliding(spark, sf_dir):
    return Q.sliding_sequences(panel(spark, sf_dir), OHLCV, L, keys=["split", "Ticker"])


@register("sequences_sliding", with_(*PANEL_CTES, _SEQ) + "SELECT * FROM seq")
def q_sliding(spark, sf_dir):
    return sliding(spark, sf_dir)


MAX_FIT_SEQUENCES = 150_000      # fixed value: at most so many sequences are fitted on
SMALL_CAP = 20_000               # a bound below the rows of the smaller tables


@register("sequences_capped", with_(*PANEL_CTES, _SEQ) + f"""
SELECT * FROM seq WHERE split = 'train'
ORDER BY md5('42|' || "Ticker" || '|' || CAST("Date" AS VARCHAR)), "Ticker", "Date" LIMIT {MAX_FIT_SEQUENCES}""")
def q_capped(spark, sf_dir, most: int = MAX_FIT_SEQUENCES):
    s = sliding(spark, sf_dir).where(F.col("split") == "train")
    return Q.capped(s, most, 42)


@register("sequences_capped_small", with_(*PANEL_CTES, _SEQ) + f"""
SELECT * FROM seq WHERE split = 'train'
ORDER BY md5('42|' || "Ticker" || '|' || CAST("Date" AS VARCHAR)), "Ticker", "Date" LIMIT {SMALL_CAP}""")
def q_capped_small(spark, sf_dir):
    """F5 with a bound that is reached."""
    return q_capped(spark, sf_dir, SMALL_CAP)


@register("sequences_value_stats", with_(*PANEL_CTES, _SEQ) + """
SELECT split, count(*) AS cells, CAST(0 AS BIGINT) AS nan, CAST(0 AS BIGINT) AS inf, min(v) AS min, max(v) AS max,
       round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std
FROM (SELECT split, UNNEST(flatten("X")) AS v FROM seq) GROUP BY split""")
def q_value_stats(spark, sf_dir):
    st = Q.sequence_value_stats(sliding(spark, sf_dir), "X", "split")
    return st.select("split", "cells", "nan", "inf", "min", "max", (F.round("mean", 6) + 0.0).alias("mean"),
                     (F.round("std", 6) + 0.0).alias("std"))


@register("sequences_flattened", with_(*PANEL_CTES, _SEQ) + """
SELECT split, "Ticker", "Date", flatten("X") AS x_flat, len(flatten("X")) AS width FROM seq""")
def q_flat(spark, sf_dir):
    s = sliding(spark, sf_dir)
    flat = Q.flatten_sequence("X")
    return s.select("split", "Ticker", "Date", flat.alias("x_flat"), F.size(flat).alias("width"))


@register("sequences_latest", with_(BARS) + f"""
SELECT "Ticker", "Date", "X" FROM (
  SELECT "Ticker", "Date",
         list(["Open", "High", "Low", "Close", "Volume"]) OVER (PARTITION BY "Ticker" ORDER BY "Date"
              ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW) AS "X",
         row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS r,
         row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date") AS rn FROM bars) WHERE r = 1 AND rn >= {L}""")
def q_latest(spark, sf_dir):
    return Q.latest_sequence(load_bars(spark, sf_dir), OHLCV, L)


_EW = "PARTITION BY user_id ORDER BY ts, event_id"


@register("sequences_with_horizon", f"""
SELECT user_id, ts, event_id, "X", "Y" FROM (
  SELECT user_id, ts, event_id,
         list([value]) OVER ({_EW} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS "X",
         [[lead(value, 1) OVER ({_EW})], [lead(value, 2) OVER ({_EW})], [lead(value, 3) OVER ({_EW})]] AS "Y",
         row_number() OVER ({_EW}) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)
WHERE rn >= 10 AND rn <= n - 3""")
def q_horizon(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return Q.sequences_with_horizon(ev, ["value"], 10, 3, "user_id", ["ts", "event_id"])


_MONTHLY = """monthly AS (SELECT "Ticker", date_trunc('month', "Date")::DATE AS month,
  list("Close" ORDER BY "Date") AS closes FROM bars GROUP BY ALL)"""


def monthly_closes(spark, sf_dir):
    b = load_bars(spark, sf_dir)
    return (b.groupBy("Ticker", F.trunc("Date", "MM").alias("month"))
            .agg(F.sort_array(F.collect_list(F.struct("Date", "Close"))).alias("_s"))
            .select("Ticker", "month", F.transform("_s", lambda x: x["Close"]).alias("closes")))


@register("sequences_padded", with_(BARS, _MONTHLY) + """
SELECT "Ticker", month, list_concat(list_resize([]::DOUBLE[], 31 - len(closes), 0.0), closes) AS pre,
       list_concat(closes, list_resize([]::DOUBLE[], 31 - len(closes), 0.0)) AS post,
       CAST(len(closes) AS INTEGER) AS length, closes[1:10] AS head10 FROM monthly""")
def q_padded(spark, sf_dir):
    m = monthly_closes(spark, sf_dir)
    return m.select("Ticker", "month", Q.pad("closes", 31, "pre").alias("pre"), Q.pad("closes", 31, "post").alias("post"),
                    F.size("closes").alias("length"), Q.truncate("closes", 10).alias("head10"))


@register("sequences_sampled_positions", with_(*PANEL_CTES, _SEQ) + """
SELECT * EXCLUDE (r, n) FROM (SELECT *, count(*) OVER (PARTITION BY "Ticker") AS n,
  row_number() OVER (PARTITION BY "Ticker" ORDER BY md5('42|' || "Ticker" || '|' || CAST("Date" AS VARCHAR))) AS r
  FROM seq WHERE split = 'train') WHERE r <= floor(n * 0.1::DOUBLE)""")
def q_sampled(spark, sf_dir):
    """10 % of the positions of each series."""
    return Q.sample_positions(sliding(spark, sf_dir).where(F.col("split") == "train"), 0.1, 42)


MI_SAMPLE_ROWS = 500_000         # fixed value: rows of a ranking sample


@register("sample_rows_seeded", with_(*PANEL_CTES) + f"""
SELECT * FROM panel WHERE split = 'train'
ORDER BY md5('42|' || "Ticker" || '|' || CAST("Date" AS VARCHAR)), "Ticker", "Date" LIMIT {MI_SAMPLE_ROWS}""")
def q_sample_rows(spark, sf_dir, rows: int = MI_SAMPLE_ROWS):
    """a fixed-size seeded sample."""
    p = panel(spark, sf_dir).where(F.col("split") == "train")
    return Q.sample_rows(p, rows, 42, ["Ticker", "Date"])


@register("sample_rows_seeded_small", with_(*PANEL_CTES) + f"""
SELECT * FROM panel WHERE split = 'train'
ORDER BY md5('42|' || "Ticker" || '|' || CAST("Date" AS VARCHAR)), "Ticker", "Date" LIMIT {SMALL_CAP}""")
def q_sample_rows_small(spark, sf_dir):
    """F6 with fewer rows than the table has."""
    return q_sample_rows(spark, sf_dir, SMALL_CAP)
