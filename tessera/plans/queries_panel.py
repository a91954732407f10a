"""Queries over sources, cleaning, labels and splits (A*, B*, C1, D1-D5, J1-J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators.labels import forward_label, label_distribution
from tessera.operators.splits import split_by_position, split_report
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import BARS, CLEAN, GAPPY, LABELLED, PANEL_CTES, clean_cte, with_
from tessera.plans.process import process
from tessera.sources.bars import load_bars, load_gappy_bars
from tessera.sources.tables import read_table


def panel(spark, sf_dir):
    """Cleaned, labelled, split panel built from all daily bars."""
    return process(load_bars(spark, sf_dir))


@register("daily_bars", with_(BARS) + "SELECT * FROM bars")
def q_daily_bars(spark, sf_dir):
    return load_bars(spark, sf_dir)


@register("dataset_profile", with_(BARS) + """
SELECT count(*) AS "rows", count(DISTINCT "Ticker") AS series,
       min("Date") AS first_date, max("Date") AS last_date FROM bars""")
def q_dataset_profile(spark, sf_dir):
    return C.dataset_profile(load_bars(spark, sf_dir))


@register("missing_profile", with_(BARS, GAPPY) + """
SELECT "column", missing FROM (
  SELECT 'Date' AS "column", count_if("Date" IS NULL) AS missing FROM gappy
  UNION ALL SELECT 'Ticker', count_if("Ticker" IS NULL) FROM gappy
  UNION ALL SELECT 'Open', count_if("Open" IS NULL) FROM gappy
  UNION ALL SELECT 'High', count_if("High" IS NULL) FROM gappy
  UNION ALL SELECT 'Low', count_if("Low" IS NULL) FROM gappy
  UNION ALL SELECT 'Close', count_if("Close" IS NULL) FROM gappy
  UNION ALL SELECT 'Volume', count_if("Volume" IS NULL) FROM gappy
  UNION ALL SELECT 'Dividends', count_if("Dividends" IS NULL) FROM gappy
  UNION ALL SELECT 'Stock Splits', count_if("Stock Splits" IS NULL) FROM gappy)
WHERE missing > 0""")
def q_missing_profile(spark, sf_dir):
    return C.missing_profile(load_gappy_bars(spark, sf_dir))


@register("clean_panel", with_(BARS, GAPPY, CLEAN) + "SELECT * FROM clean")
def q_clean_panel(spark, sf_dir):
    return C.handle_missing_values(load_gappy_bars(spark, sf_dir))


@register("cleaning_report", with_(BARS, GAPPY, CLEAN) + """
SELECT b.rows_before, a.rows_after, b.rows_before - a.rows_after AS rows_removed,
       b.series_before, a.series_after
FROM (SELECT count(*) AS rows_before, count(DISTINCT "Ticker") AS series_before FROM gappy) b,
     (SELECT count(*) AS rows_after, count(DISTINCT "Ticker") AS series_after FROM clean) a""")
def q_cleaning_report(spark, sf_dir):
    raw = load_gappy_bars(spark, sf_dir)
    return C.cleaning_report(raw, C.handle_missing_values(raw))


@register("invalid_price_filter", with_(BARS, GAPPY) + """
SELECT * FROM gappy WHERE "Open" > 0 AND "High" > 0 AND "Low" > 0 AND "Close" > 0""")
def q_invalid_price_filter(spark, sf_dir):
    return C.drop_invalid_prices(load_gappy_bars(spark, sf_dir))


@register("forward_label", with_(BARS, clean_cte("bars"), LABELLED) + "SELECT * FROM labelled")
def q_forward_label(spark, sf_dir):
    return forward_label(C.handle_missing_values(load_bars(spark, sf_dir)))


@register("split_panel", with_(*PANEL_CTES) + "SELECT * FROM panel")
def q_split_panel(spark, sf_dir):
    return panel(spark, sf_dir)


@register("split_report", with_(*PANEL_CTES) + """
SELECT split, "rows", first_date, last_date, positives,
       round("rows" * 100.0 / sum("rows") OVER (), 6) AS row_pct,
       round(positives * 100.0 / "rows", 6) AS positive_pct
FROM (SELECT split, count(*) AS "rows", min("Date") AS first_date, max("Date") AS last_date,
             CAST(sum(target) AS BIGINT) AS positives FROM panel GROUP BY split)""")
def q_split_report(spark, sf_dir):
    return split_report(panel(spark, sf_dir))


@register("label_distribution", with_(*PANEL_CTES) + """
SELECT split, target, n, round(n * 100.0 / sum(n) OVER (PARTITION BY split), 6) AS pct
FROM (SELECT split, target, count(*) AS n FROM panel GROUP BY split, target)""")
def q_label_distribution(spark, sf_dir):
    return label_distribution(panel(spark, sf_dir), by="split")


@register("series_row_counts", with_(BARS) + """
SELECT "Ticker", count(*) AS n FROM bars GROUP BY "Ticker" """)
def q_series_row_counts(spark, sf_dir):
    return load_bars(spark, sf_dir).groupBy("Ticker").agg(F.count(F.lit(1)).alias("n"))


@register("distinct_keys", with_(*PANEL_CTES) + """
SELECT split, count(DISTINCT "Ticker") AS tickers, count(DISTINCT "Date") AS dates
FROM panel GROUP BY split""")
def q_distinct_keys(spark, sf_dir):
    return (panel(spark, sf_dir).groupBy("split")
            .agg(F.count_distinct("Ticker").alias("tickers"), F.count_distinct("Date").alias("dates")))


@register("last_close_per_series", with_(*PANEL_CTES) + """
SELECT "Ticker", arg_max("Close", "Date") AS last_close, max("Date") AS last_date
FROM panel WHERE split = 'train' GROUP BY "Ticker" """)
def q_last_close(spark, sf_dir):
    p = panel(spark, sf_dir).where(F.col("split") == "train")
    return p.groupBy("Ticker").agg(F.max_by("Close", "Date").alias("last_close"),
                                   F.max("Date").alias("last_date"))


@register("class_weights", with_(*PANEL_CTES) + """
SELECT target, n, round(sum(n) OVER () / (count(*) OVER () * n), 10) AS weight
FROM (SELECT target, count(*) AS n FROM panel WHERE split = 'train' GROUP BY target)""")
def q_class_weights(spark, sf_dir):
    from tessera.operators.fit import class_weights
    return class_weights(panel(spark, sf_dir).where(F.col("split") == "train"))


@register("position_split", """
SELECT user_id, ts, event_id, value,
       CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train'
            WHEN pos < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT user_id, ts, event_id, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
             count(*) OVER (PARTITION BY user_id) AS n FROM events)""")
def q_position_split(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return split_by_position(ev, "user_id", ["ts", "event_id"])


@register("semi_join_requested", with_(BARS) + """
SELECT b.* FROM bars b WHERE b."Ticker" IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 12)""")
def q_semi_join(spark, sf_dir):
    from tessera.operators.submission import keep_requested
    sup = read_table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 12)
    ids = sup.select(F.col("s_suppkey").cast("string").alias("ID"))
    return keep_requested(load_bars(spark, sf_dir), ids)
