"""Panel sources derived from the given tables.

``daily_bars``: OHLCV bars per (series, day) from transaction rows.  Each task combines
its rows of one series and day before the only shuffle, which is by series: a series holding
a third of all raw rows arrives as a row per day and chunk of rows, and windows over
the series need no shuffle of their own.  After this step each series has at most one row per
calendar day, which is the size bound every per-series window downstream relies on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StructField, StructType

from tessera.sources.tables import read_table

PANEL_COLUMNS = ["Date", "Ticker", "Open", "High", "Low", "Close", "Volume",
                 "Dividends", "Stock Splits"]


def daily_bars(lineitem: DataFrame) -> DataFrame:
    """lineitem -> (Ticker, Date, Open, High, Low, Close, Volume, Dividends, Stock Splits).

    Ticker = supplier key as string, Date = ship day, row price =
    extendedprice / quantity.  Open / Close are the first / last price of the
    day in (orderkey, linenumber, price) order -- the price in the key makes
    the choice deterministic even where (orderkey, linenumber) repeats.
    """
    rows = lineitem.select(
        F.col("l_suppkey").alias("key"),
        F.col("l_shipdate").cast("date").alias("Date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.col("l_quantity").alias("q"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
    )
    parts = combined(rows).withColumn("Ticker", F.col("key").cast("string")).drop("key").repartition("Ticker")
    several = F.col("more").isNotNull()
    more = lambda c: F.when(several, F.col(f"more.{c}")).otherwise(F.col("p"))
    last = F.when(several, F.col("more.last")).otherwise(F.struct("ok", "ln", "p"))
    return (parts.groupBy("Ticker", "Date")
            .agg(F.min_by("p", F.struct("ok", "ln", "p")).alias("Open"),
                 F.max(more("high")).alias("High"),
                 F.min(more("low")).alias("Low"),
                 F.max_by(last["p"], last).alias("Close"),
                 F.sum("q").alias("Volume"))
            .select("Date", "Ticker", "Open", "High", "Low", "Close", "Volume",
                    F.lit(0.0).alias("Dividends"), F.lit(0.0).alias("Stock Splits")))


COMBINED_ROWS = 1 << 17     # rows that a task combines at a time


def combined(rows: DataFrame, chunk_rows: int = COMBINED_ROWS) -> DataFrame:
    """``rows`` (key, Date, p, q, ok, ln) with those of one key and Date combined, ``chunk_rows`` of a task at
    a time: ok, ln and p of the first, the sum of q, and in ``more`` the last and the highest and lowest p.
    ``more`` is NULL for a row that stayed single, as do rows with a NULL or NaN, and columns of other
    types than numbers."""
    kinds = {f.name: f.dataType for f in rows.schema}
    order = StructType([StructField(c, kinds[c]) for c in ("ok", "ln", "p")])
    more = StructType([StructField("last", order), StructField("high", kinds["p"]), StructField("low", kinds["p"])])
    whole = all(isinstance(kinds[c], IntegralType) for c in ("key", "ok", "ln"))
    if not (whole and isinstance(kinds["p"], DoubleType) and isinstance(kinds["q"], DoubleType)):
        return rows.withColumn("more", F.lit(None).cast(more))
    columns = rows.columns
    return rows.mapInArrow(_combined(chunk_rows, columns), StructType([*rows.schema.fields, StructField("more", more)]))


def _combined(chunk_rows: int, columns: list[str]):
    def chunks(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= chunk_rows:
                yield held
                held, n = [], 0
        if held:
            yield held

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for held in chunks(batches):
            batch = pa.concat_batches(held)
            kinds = {c: batch.column(c).type for c in columns}
            order = pa.struct([pa.field(c, kinds[c]) for c in ("ok", "ln", "p")])
            kind = pa.struct([pa.field("last", order), pa.field("high", kinds["p"]), pa.field("low", kinds["p"])])
            known = np.ones(batch.num_rows, bool)
            for c in columns:
                if batch.column(c).null_count:
                    known &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
            for c in ("p", "q"):
                known &= ~np.isnan(batch.column(c).to_numpy(zero_copy_only=False))
            if not known.all():
                alone = batch.filter(pa.array(~known))
                yield pa.RecordBatch.from_arrays([*alone.columns, pa.nulls(alone.num_rows, kind)], [*columns, "more"])
                batch = batch.filter(pa.array(known))
                if not batch.num_rows:
                    continue
            x = {c: batch.column(c).cast(pa.int32()).to_numpy() if c == "Date" else batch.column(c).to_numpy() for c in columns}
            by = np.lexsort((x["Date"], x["key"]))
            x = {c: v[by] for c, v in x.items()}
            new = np.append(True, (x["key"][1:] != x["key"][:-1]) | (x["Date"][1:] != x["Date"][:-1]))
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(new)))
            several = sizes > 1
            if several.any():
                # only rows that share their day are put in order of (ok, ln, p)
                at = np.flatnonzero(np.repeat(several, sizes))
                day = np.repeat(np.arange(len(starts)), sizes)[at]
                inside = at[np.lexsort((x["p"][at], x["ln"][at], x["ok"][at], day))]
                for c in ("ok", "ln", "p", "q"):
                    x[c][at] = x[c][inside]
            last = starts + sizes - 1
            end = pa.StructArray.from_arrays([pa.array(x[c][last], kinds[c]) for c in ("ok", "ln", "p")], fields=list(order))
            more = pa.StructArray.from_arrays(
                [end, pa.array(np.maximum.reduceat(x["p"], starts)), pa.array(np.minimum.reduceat(x["p"], starts))],
                fields=list(kind), mask=pa.array(~several))
            total = np.add.reduceat(x["q"], starts)
            out = {c: pa.array((total if c == "q" else x[c][starts])).cast(kinds[c]) for c in columns}
            yield pa.RecordBatch.from_arrays([*[out[c] for c in columns], more], [*columns, "more"])
    return run


def with_gaps(bars: DataFrame) -> DataFrame:
    """Blank values by a fixed calendar rule, to exercise the cleaning path.

    Close is NULL on days of month divisible by 7, Volume on days divisible
    by 5, Dividends on days divisible by 3, and Open is 0 (an invalid price)
    on the 11th and 22nd of every fourth month.
    """
    d = F.dayofmonth("Date")
    m = F.month("Date")
    return bars.select(
        "Date", "Ticker",
        F.when(((d == 11) | (d == 22)) & (m % 4 == 0), F.lit(0.0)).otherwise(F.col("Open")).alias("Open"),
        "High", "Low",
        F.when(d % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("Close")).alias("Close"),
        F.when(d % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("Volume")).alias("Volume"),
        F.when(d % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("Dividends")).alias("Dividends"),
        "Stock Splits",
    )


def load_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(read_table(spark, sf_dir, "lineitem"))


def load_gappy_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_gaps(load_bars(spark, sf_dir))


def scoring_requests(supplier: DataFrame, unknown_offset: int = 1_000_000) -> DataFrame:
    """Scoring request table (ID, Date) derived from the supplier table.

    Every supplier is requested; suppliers of nation 0 are requested a second
    time under an id shifted by ``unknown_offset``, which no history knows
    (this exercises the unmatched -> default path of the submission).
    """
    known = supplier.select(F.col("s_suppkey").cast("string").alias("ID"))
    unknown = (supplier.where(F.col("s_nationkey") == 0)
               .select((F.col("s_suppkey") + F.lit(unknown_offset)).cast("string").alias("ID")))
    return known.unionByName(unknown).select("ID", F.lit(None).cast("date").alias("Date"))
