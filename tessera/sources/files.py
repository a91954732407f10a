"""File sources and sinks of the pipelines.

Explicit schemas everywhere (no ``inferSchema``: one scan, stable types);
the large tables are written as parquet partitioned by split so that
downstream reads prune partitions; small run metadata (feature list, scaler
statistics, rankings, model comparison) is written as tables, not pickles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize

PANEL_SCHEMA = ("Date DATE, Ticker STRING, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, "
                "Volume DOUBLE, Dividends DOUBLE, `Stock Splits` DOUBLE")
REQUEST_SCHEMA = "ID STRING, Date DATE"


def read_panel_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: the raw panel CSV (header) with its fixed schema; files split by Spark."""
    return spark.read.schema(PANEL_SCHEMA).option("header", True).csv(path)


def read_panel_csv_tolerant(spark: SparkSession, path: str, schema: str = PANEL_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """A1 with bad rows: (rows, quarantine).

    ``rows`` are those of ``read_panel_csv`` whose line fits the schema; an empty field is a null.
    ``quarantine`` has (file, line, unread) of all other lines: text in a date or number, too few
    or too many fields; ``unread`` lists the columns without a value.  The lines are parsed whole
    and once, into a table in the shared folder, so each is in one of the two, whatever columns
    are asked for later.
    """
    raw = (spark.read.schema(f"{schema}, _line STRING").option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line").csv(path))
    quoted = {c: f"`{c}`" for c in raw.columns if c != "_line"}
    parsed = materialize(raw.select("*", F.col("_metadata.file_name").alias("_file")))
    unread = F.array_compact(F.array(*[F.when(F.col(q).isNull(), F.lit(c)) for c, q in quoted.items()]))
    return (parsed.where(F.col("_line").isNull()).select(*quoted.values()),
            parsed.where(F.col("_line").isNotNull())
            .select(F.col("_file").alias("file"), F.col("_line").alias("line"), unread.alias("unread")))


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """(file, unread, n): quarantined lines per file and set of unread columns."""
    return quarantine.groupBy("file", "unread").agg(F.count(F.lit(1)).alias("n"))


def read_requests_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2: scoring requests (ID, Date)."""
    return spark.read.schema(REQUEST_SCHEMA).option("header", True).csv(path)


def read_table_any(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A3: feature tables written by ``write_features`` (parquet; CSV accepted)."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.option("header", True).format(fmt).load(path)


def write_splits(panel: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A4: the processed panel, one partition folder per split."""
    panel.write.mode("overwrite").partitionBy("split").format(fmt).option("header", True).save(path)


def write_series(df: DataFrame, table: str, path: str, keys: Sequence[str] = ("Ticker",),
                 order: Sequence[str] = ("Date",), buckets: int | None = None) -> DataFrame:
    """A4 and A5 laid out by series: the external table ``table`` at ``path`` in ``buckets`` buckets by
    ``keys`` (as many as shuffle partitions, unless given), one sorted file in each; returns the
    table.  Windows and joins by (more than) ``keys`` need no exchange on it, nor does any step
    after the hand-over.  A table of that name and its files are replaced.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys, *order)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


# Integer features that fit a smaller type at the sink
SMALL = {"year": "smallint"} | {c: "tinyint" for c in (
    "target", "day_of_week", "day_of_month", "month", "quarter", "days_since_month_start", "days_until_month_end",
    "is_month_start", "is_month_end", "is_bull_market", "is_bear_market", "is_high_volatility", "trend_direction")}


def write_features(features: DataFrame, columns: Sequence[str], path: str, small: bool = True) -> None:
    """A5 + B8: Date, Ticker, target and the selected features; with ``small`` in the
    smallest type that holds them (float, tinyint, smallint)."""
    cols = [F.col("Date"), F.col("Ticker")]
    cols += [F.col(c).cast(SMALL.get(c, "float")).alias(c) if small else F.col(c) for c in ["target", *columns]]
    keep = ["split"] if "split" in features.columns else []
    out = features.select(*keep, *cols)
    w = out.write.mode("overwrite")
    (w.partitionBy("split") if keep else w).parquet(path)


def write_submission(submission: DataFrame, path: str) -> None:
    """CSV files with header, sorted by ID within and across files (part numbers give the order)."""
    submission.repartitionByRange("ID").sortWithinPartitions("ID").write.mode("overwrite").option(
        "header", True).csv(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """Run metadata as a table: feature list, scaler, feature importance, model comparison."""
    df.write.mode("overwrite").parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A8."""
    return spark.read.parquet(path)


def feature_list_table(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """The selected feature list with its order."""
    return spark.createDataFrame([(i, c) for i, c in enumerate(features)], "position INT, feature STRING")


def importance_table(mutual_info: DataFrame) -> DataFrame:
    """Features ranked by importance (one row per feature)."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.orderBy(F.col("mutual_info").desc(), "feature"))
    return mutual_info.select("feature", "mutual_info", rank.alias("rank"))


def comparison_table(results: DataFrame) -> DataFrame:
    """The model comparison (one row per model) from ``metrics.model_results``."""
    from tessera.operators.metrics import model_leaderboard
    return model_leaderboard(results)
