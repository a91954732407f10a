"""Lookups and set operations of the scoring / submission path.

No join here forces a broadcast: both sides can grow with the number of
series, so the strategy is left to Spark (it broadcasts on its own when the
statistics show a side under ``spark.sql.autoBroadcastJoinThreshold``, and
AQE re-plans at run time from the real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import assert_binary


def keep_requested(panel: DataFrame, requests: DataFrame, key: str = "Ticker",
                   id_col: str = "ID") -> DataFrame:
    """Rows of the panel whose series is requested (left semi join)."""
    ids = requests.select(F.col(id_col).alias(key)).distinct()
    return panel.join(ids, key, "left_semi")


def unknown_requests(requests: DataFrame, panel: DataFrame, key: str = "Ticker",
                     id_col: str = "ID") -> DataFrame:
    """C4: requested ids no history knows (left anti join)."""
    known = panel.select(F.col(key).alias(id_col)).distinct()
    return requests.select(id_col).distinct().join(known, id_col, "left_anti")


def common_keys(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Intersection of two key sets."""
    return a.select(col).intersect(b.select(col))


def missing_keys(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Keys of ``a`` absent from ``b`` (set difference)."""
    return a.select(col).subtract(b.select(col))


def latest_per_key(predictions: DataFrame, key: str = "Ticker", order: str = "Date",
                   value: str = "Pred") -> DataFrame:
    """One prediction per series: the one with the latest date (dedupe before mapping)."""
    return predictions.groupBy(key).agg(F.max_by(value, order).alias(value))


def assemble_submission(requests: DataFrame, predictions: DataFrame, key: str = "Ticker",
                        id_col: str = "ID", value: str = "Pred", order: str = "Date") -> DataFrame:
    """Map every requested id to its series' prediction, 0 when unknown.

    C3 (left lookup, default 0, int), which keeps every request, + B12 (0/1
    check) + F1 (sorted by id).
    """
    preds = latest_per_key(predictions, key, order, value).withColumnRenamed(key, id_col)
    mapped = (requests.select(id_col).join(preds, id_col, "left")
              .select(id_col, F.coalesce(F.col(value), F.lit(0)).cast("int").alias(value)))
    return assert_binary(mapped, value).orderBy(id_col)


def match_report(requests: DataFrame, predictions: DataFrame, key: str = "Ticker",
                 id_col: str = "ID") -> DataFrame:
    """Matched / unmatched request counts of C3."""
    known = predictions.select(F.col(key).alias(id_col), F.lit(1).alias("_hit")).distinct()
    j = requests.select(id_col).join(known, id_col, "left")
    return j.agg(F.count(F.lit(1)).alias("requests"),
                 F.count("_hit").alias("matched"),
                 F.count_if(F.col("_hit").isNull()).alias("unmatched"))
