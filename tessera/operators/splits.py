"""Date-ordered train / validation / test splits.

The result is one DataFrame with a ``split`` column rather than three
copies, so one plan feeds every split and later per-split windows can
partition by (split, series) on the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import positions

SPLITS = ("train", "val", "test")


def check_ratios(train: float, val: float, test: float) -> None:
    total = train + val + test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"train + val + test is {total}, not 1")


def date_splits(df: DataFrame, order: str = "Date", train: float = 0.7, val: float = 0.15,
                test: float = 0.15) -> DataFrame:
    """(order, split): the split of every distinct date, cut at int(n*train) and
    int(n*(train+val)).  One row per date of the calendar span, whatever the data volume."""
    check_ratios(train, val, test)
    dates = df.select(order).where(F.col(order).isNotNull()).distinct()
    i = F.row_number().over(Window.orderBy(order)) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return dates.select(order, F.when(i < F.floor(n * F.lit(float(train))), "train")
                        .when(i < F.floor(n * F.lit(float(train) + float(val))), "val").otherwise("test").alias("split"))


def split_by_date(df: DataFrame, order: str = "Date", train: float = 0.7, val: float = 0.15,
                  test: float = 0.15) -> DataFrame:
    """Rows joined lazily with the split of their date; no job runs while planning.

    A ``DATE`` column has at most a few tens of thousands of distinct values, so
    its split table is broadcast, and the rows keep their partitioning by
    series; for any other type Spark picks the join by size.  Rows without a
    date fall out (they have no place in a date order).
    """
    splits = date_splits(df, order, train, val, test)
    if dict(df.dtypes)[order] == "date":
        splits = F.broadcast(splits)
    columns = df.columns
    return df.join(splits, order).select(*[F.col(f"`{c}`") for c in columns], "split")


def split_by_position(df: DataFrame, keys="Ticker", order="Date", train: float = 0.7,
                      val: float = 0.15, test: float = 0.15) -> DataFrame:
    """Per series, positional cut at a = int(n*train) and a + int(n*val).  Positions are
    numbered range by range, so a series of any length is split over tasks."""
    check_ratios(train, val, test)
    k = [keys] if isinstance(keys, str) else list(keys)
    o = [order] if isinstance(order, str) else list(order)
    a = F.floor(F.col("_n") * F.lit(train))
    b = a + F.floor(F.col("_n") * F.lit(val))
    split = F.when(F.col("_pos") < a, "train").when(F.col("_pos") < b, "val").otherwise("test")
    return positions(df, k, o).select(*[F.col(f"`{c}`") for c in df.columns], split.alias("split"))


def split_report(df: DataFrame, order: str = "Date", target: str = "target") -> DataFrame:
    """Rows, share of rows, date range and share of positive labels per split."""
    per_split = (df.groupBy("split")
                 .agg(F.count(F.lit(1)).alias("rows"),
                      F.min(order).alias("first_date"), F.max(order).alias("last_date"),
                      F.sum(target).cast("bigint").alias("positives")))
    # the share needs the grand total: a window over the <= 3 aggregated rows
    total = F.sum("rows").over(Window.partitionBy())
    return (per_split
            .withColumn("row_pct", F.round(F.col("rows") * 100.0 / total, 6))
            .withColumn("positive_pct", F.round(F.col("positives") * 100.0 / F.col("rows"), 6)))
