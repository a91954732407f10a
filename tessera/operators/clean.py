"""Cleaning of a raw panel: fills, invalid-row and short-series filters, profiles.

All fills are window expressions over one partition / order spec, so Spark
shuffles the panel once by the series key and evaluates every fill in the
same pass.  Frames are either running (``unboundedPreceding .. currentRow``,
incremental) or the whole partition (evaluated once per partition); no
``unboundedFollowing`` suffix frame, which Spark evaluates in O(n^2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICE_COLS = ("Open", "High", "Low", "Close")
VOLUME_COL = "Volume"
ZERO_FILL_COLS = ("Dividends", "Stock Splits")
HORIZON = 30  # fixed value: label horizon in rows; series need HORIZON + 1 rows


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def series_window(keys="Ticker", order="Date"):
    return Window.partitionBy(*_keys(keys)).orderBy(*_keys(order))


def ffill(c: str, keys="Ticker", order="Date") -> Column:
    """B1: last non-null value up to the current row of the series."""
    w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.col(f"`{c}`"), ignorenulls=True).over(w)


def first_valid(c: str, keys="Ticker", order="Date") -> Column:
    """First non-null value of the whole ordered series (one evaluation per partition)."""
    w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(F.col(f"`{c}`"), ignorenulls=True).over(w)


def fill_series(c: str, keys="Ticker", order="Date", default: float = 0.0) -> Column:
    """B1+B2+B3: forward fill, then back fill, then ``default``.

    After a forward fill only a leading run can still be NULL, and a back
    fill gives it the series' first valid value -- hence the whole-partition
    ``first(ignorenulls)``.
    """
    return F.coalesce(ffill(c, keys, order), first_valid(c, keys, order), F.lit(default))


def handle_missing_values(df: DataFrame, keys="Ticker", order="Date",
                          price_cols: Sequence[str] = PRICE_COLS, volume_col: str = VOLUME_COL,
                          zero_cols: Sequence[str] = ZERO_FILL_COLS,
                          min_rows: int = HORIZON + 1) -> DataFrame:
    """Fills (B1-B3), invalid-price filter (B4), short-series filter.

    Volume's back fill is done per series (the reference's is not grouped;
    the two differ only for a series whose volume is entirely missing, which
    becomes 0 here instead of borrowing another series' value).
    """
    filled = {c: fill_series(c, keys, order) for c in list(price_cols) + [volume_col]}
    for c in zero_cols:
        filled[c] = F.coalesce(F.col(f"`{c}`"), F.lit(0.0))
    out = df.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])
    valid = None
    for c in price_cols:
        cond = F.col(c) > 0
        valid = cond if valid is None else valid & cond
    out = out.where(valid)
    n = F.count(F.lit(1)).over(Window.partitionBy(*_keys(keys)))
    return out.withColumn("_n", n).where(F.col("_n") >= min_rows).drop("_n")


def cleaning_report(raw: DataFrame, clean: DataFrame, keys="Ticker") -> DataFrame:
    """Rows / series before and after cleaning and the number removed."""
    k = _keys(keys)
    # one aggregation over both inputs tagged by stage (no join needed)
    tagged = (raw.select(*k, F.lit(0).alias("_stage"))
              .unionByName(clean.select(*k, F.lit(1).alias("_stage"))))
    key = F.struct(*[F.col(x) for x in k])
    stage = F.col("_stage")
    return (tagged.agg(F.count_if(stage == 0).alias("rows_before"),
                       F.count_if(stage == 1).alias("rows_after"),
                       F.count_distinct(F.when(stage == 0, key)).alias("series_before"),
                       F.count_distinct(F.when(stage == 1, key)).alias("series_after"))
            .select("rows_before", "rows_after",
                    (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                    "series_before", "series_after"))


def dataset_profile(df: DataFrame, keys="Ticker", order="Date") -> DataFrame:
    """Rows, distinct series, first and last date."""
    k = _keys(keys)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(*[F.col(x) for x in k]).alias("series"),
                  F.min(order).alias("first_date"), F.max(order).alias("last_date"))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: NULL count per column, only columns with at least one NULL.

    One pass (``count_if`` per column), then an unpivot of the single result
    row into (column, missing).
    """
    cols = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
                      for i, c in enumerate(cols)])
    return (counts.select(F.inline(pairs)).where(F.col("missing") > 0))


def drop_invalid_prices(df: DataFrame, price_cols: Sequence[str] = PRICE_COLS) -> DataFrame:
    """B4 on its own."""
    cond = None
    for c in price_cols:
        cond = (F.col(c) > 0) if cond is None else cond & (F.col(c) > 0)
    return df.where(cond)


def non_finite_to_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN / +-inf / NULL -> 0 for the given columns."""
    def fix(c):
        x = F.col(f"`{c}`")
        return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0)).otherwise(x)
    sel = set(columns)
    return df.select(*[fix(c).alias(c) if c in sel else F.col(f"`{c}`") for c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str], use_available: bool = False) -> list[str]:
    """Check presence of columns; optionally fall back to those present."""
    present = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    if missing and not use_available:
        raise KeyError(f"missing columns (first 10): {missing[:10]}")
    return present


def assert_binary(df: DataFrame, c: str = "Pred") -> DataFrame:
    """Lazily fail the job if ``c`` holds anything but 0 / 1."""
    ok = F.col(c).isin(0, 1) & F.col(c).isNotNull()
    return df.withColumn(c, F.when(ok, F.col(c)).otherwise(
        F.raise_error(F.concat(F.lit(f"{c} must be 0 or 1, got "), F.col(c).cast("string")))).cast(
        df.schema[c].dataType))
