"""Generic per-series window operators.

Every expression here uses one partition/order spec per call site, so a
``select`` of many of them is evaluated by Spark in a single ``Window``
operator after a single shuffle on the series key.

Two rolling semantics exist and are kept apart:

* ``rolling`` (E5): a full window is required (``n`` non-null values, else
  NULL) and ``std`` is the sample deviation -- pandas ``rolling(n)``.
  ``with_rolling`` computes many of them at a cost per row that grows with
  log n instead of n.
* ``rolling_partial`` (E10): partial windows at the series start (at least
  one row) and ``std`` is the population deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import safe_div
from tessera.operators.ranges import positions, running_sums
from tessera.operators.series import numbered, with_statistics


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def series_window(keys="Ticker", order="Date"):
    return Window.partitionBy(*_list(keys)).orderBy(*_list(order))


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def lag(c, k: int, w) -> Column:
    """E1."""
    return F.lag(_c(c), k).over(w)


def lead(c, k: int, w) -> Column:
    """E2."""
    return F.lead(_c(c), k).over(w)


def diff(c, w, k: int = 1) -> Column:
    """x(t) - x(t-k)."""
    return _c(c) - F.lag(_c(c), k).over(w)


def pct_change(c, w, k: int = 1) -> Column:
    """x(t) / x(t-k) - 1; NULL where pandas yields inf or NaN (zero base)."""
    return safe_div(_c(c), F.lag(_c(c), k).over(w)) - F.lit(1.0)


_AGG = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "pstd": F.stddev_pop,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
}


def rolling(c, n: int, fn: str, w) -> Column:
    """E5: aggregate over the last ``n`` rows, NULL unless all ``n`` are non-null."""
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    x = _c(c)
    return F.when(F.count(x).over(frame) >= n, _AGG[fn](x).over(frame))


def with_rolling(df: DataFrame, wanted: dict[str, tuple], keys="Ticker", order="Date") -> DataFrame:
    """E5 for many windows: ``df`` with a column per name of ``wanted``, name -> (column, n, fn),
    fn one of mean, std, sum, min, max; NULL unless the last ``n`` rows are all non-null.
    (column, n, "mean", k) is the mean as of k rows earlier.

    Spark's sliding frames aggregate all n rows of a frame anew for each row.  Here the windows
    of 1, 4, 16, ... rows are built from each other (a sparse table), and a window of any n from
    those: a handful of terms per window, whatever its length.  Sums add up in pairs; deviations
    merge the parts' sums of squares around their own means (no difference of large squares);
    minima and maxima may overlap.  Arrays of whole series, see ``series``.
    """
    rows = numbered(df, _list(keys), _list(order), "__number")
    return with_statistics(rows, wanted, "__number").drop("__number")


def rolling_partial(c, n: int, fn: str, w) -> Column:
    """E10 element: aggregate over up to the last ``n`` rows (partial at the start)."""
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    fn = "pstd" if fn == "std" else fn
    return _AGG[fn](_c(c)).over(frame)


def expanding_mean(c, w, default: float | None = 0.0) -> Column:
    """Running mean (NULLs skipped), ``default`` before the first value."""
    m = F.avg(_c(c)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return m if default is None else F.coalesce(m, F.lit(default))


def running_position_in_month(order: str, w) -> tuple[Column, Column]:
    """E8 in two steps on the *same* window spec (no extra partitioning).

    Step 1 marks each row that opens a new calendar month with its row
    number; step 2 (``finish``) carries that mark forward and subtracts.
    Returns (step1_mark, row_number).
    """
    rn = F.row_number().over(w)
    month = F.trunc(F.col(order), "MM")
    opens = F.lag(month, 1).over(w).isNull() | (F.lag(month, 1).over(w) != month)
    return F.when(opens, rn), rn


def position_in_month_finish(mark: str, rn: str, w) -> Column:
    carried = F.last(F.col(mark), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.col(rn) - carried + F.lit(1)


def last_n_rows(df: DataFrame, n: int, keys="Ticker", order="Date") -> DataFrame:
    """the last ``n`` rows of every series (``tail(n)``)."""
    w = Window.partitionBy(*_list(keys)).orderBy(*[F.col(o).desc() for o in _list(order)])
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


# ---- raw-row series ------------------------------------------------------------
#
# Windows partitioned by the series key put a whole series into one task.
# Daily bars are bounded by their number of days, but a raw-row series (one
# user's events) is not: one key may hold a third of all rows, even on one
# day.  For windows with bounded look-back and look-ahead the series is cut
# into chunks of positions (``ranges.positions``, numbered without a window
# per series); the rows next to each chunk are copied into it as a halo, the
# windows run per (key, chunk), and the halo rows are dropped.  The results
# are exactly those of the per-series window.

CHUNK_ROWS = 100_000


def chunk_positions(df: DataFrame, keys, order, before: int, after: int = 0,
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_pos`` (0-based position in the series), ``_n`` (series length),
    ``_chunk`` and ``_halo``; each chunk also holds copies of the last ``before``
    rows of the one before it and of the first ``after`` rows of the next."""
    return copies_in_chunks(positions(df, _list(keys), _list(order)), before, after, chunk_rows)


def copies_in_chunks(pos: DataFrame, before: int, after: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The second half of ``chunk_positions``, for rows that have their position ``_pos``."""
    if max(before, after) >= chunk_rows:
        raise ValueError("chunk_rows must exceed the look-back and the look-ahead")
    chunk, at = F.floor(F.col("_pos") / chunk_rows), F.col("_pos") % chunk_rows
    place = lambda c, halo: F.struct(c.alias("c"), F.lit(halo).alias("h"))
    copies = [F.array(place(chunk, False)),
              F.when(at >= chunk_rows - before, F.array(place(chunk + 1, True))),
              F.when((at < after) & (chunk > 0), F.array(place(chunk - 1, True)))]
    none = F.array().cast("array<struct<c:bigint,h:boolean>>")
    out = pos.withColumn("_cp", F.explode(F.concat(*[F.coalesce(c, none) for c in copies])))
    return out.withColumn("_chunk", F.col("_cp.c")).withColumn("_halo", F.col("_cp.h")).drop("_cp")


def by_chunk(df: DataFrame, columns, keys, order, before: int, after: int = 0, chunk_rows: int = CHUNK_ROWS,
             keep: Column | None = None) -> DataFrame:
    """Keys, order and ``columns(window)`` per row, windows over chunks; ``keep`` filters by ``_pos`` and ``_n``."""
    c = chunk_positions(df, keys, order, before, after, chunk_rows)
    w = Window.partitionBy(*_list(keys), "_chunk").orderBy("_pos")
    out = c.select(*[F.col(x) for x in _list(keys) + _list(order)], *columns(w), "_pos", "_n", "_halo")
    out = out.where(~F.col("_halo") if keep is None else keep & ~F.col("_halo"))
    return out.drop("_pos", "_n", "_halo")


def apply_per_series(df: DataFrame, fn, schema: str, keys, order, before: int, after: int = 0,
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """O2: a function of the user's own over every series, chunk by chunk.

    ``fn`` gets a pandas frame with the columns of ``df``, rows of one series in order, and
    returns one row of ``schema`` for each of them, also in order.  It may look ``before`` rows
    back and ``after`` rows ahead: those of the neighbouring chunks come with the frame, and
    what it returns for them is left out.  At the ends of a series there are fewer.  A task holds
    at most ``chunk_rows + before + after`` rows, however long the series.  A frame of another
    length than the one handed in fails the job; an empty table gives an empty result.
    """
    columns = df.columns

    def run(pdf):
        pdf = pdf.sort_values("_pos")
        out = fn(pdf[columns].reset_index(drop=True))
        if len(out) != len(pdf):
            raise ValueError(f"{len(out)} rows returned for {len(pdf)}")
        return out[~pdf["_halo"].to_numpy()]

    c = chunk_positions(df, keys, order, before, after, chunk_rows)
    return c.groupBy(*_list(keys), "_chunk").applyInPandas(run, schema)


def _long_enough(least: int, what: str) -> Column:
    """A filter predicate (evaluated for every row) that fails the job for a shorter series."""
    return F.when(F.col("_n") > least, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"{what} ({least}) must be less than the series length")))


def lagged_matrix(df: DataFrame, value_cols: Sequence[str], lags: Sequence[int], keys, order,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Original columns then one block per lag; the first max(lags) rows of
    each series are dropped (they lack a lag).  Output columns are named
    ``{col}`` and ``{col}_lag{k}``.  A series with max(lags) rows or fewer
    fails the job instead of silently producing no rows."""
    m = max(lags)
    columns = lambda w: [F.col(c) for c in value_cols] + [
        F.lag(F.col(c), k).over(w).alias(f"{c}_lag{k}") for k in lags for c in value_cols]
    return by_chunk(df, columns, keys, order, m, 0, chunk_rows,
                    _long_enough(m, "max lag") & (F.col("_pos") >= m))


def rolling_matrix(df: DataFrame, value_cols: Sequence[str], windows: Sequence[int],
                   functions: Sequence[str] = ("mean", "std"), keys="Ticker", order="Date",
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Partial-window statistics, column order window -> function -> column,
    named ``{col}_{fn}{n}``; population std; the series must be longer than
    max(windows)."""
    m = max(windows)
    columns = lambda w: [rolling_partial(c, n, fn, w).alias(f"{c}_{fn}{n}")
                         for n in windows for fn in functions for c in value_cols]
    return by_chunk(df, columns, keys, order, m - 1, 0, chunk_rows, _long_enough(m, "max window"))


def running_mean(df: DataFrame, col: str, keys, order, default: float = 0.0) -> DataFrame:
    """E6 on raw-row series: ``df`` with ``{col}_expanding``, the mean of the non-null values
    so far (``default`` before the first)."""
    seen = df.withColumn("_seen", F.col(col).isNotNull().cast("long"))
    sums = running_sums(seen, _list(keys), _list(order), [col, "_seen"])
    mean = F.coalesce(F.try_divide(F.col(f"cum_{col}"), F.col("cum__seen")), F.lit(default))
    return sums.select(*df.columns, mean.alias(f"{col}_expanding"))
