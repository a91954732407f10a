"""Fixed-length sequences over series.

A sequence ending at row t is ``array(vec(t-L+1), ..., vec(t))`` built from
``lag`` offsets in the series window (each an O(1) offset frame, no sliding
re-aggregation) and kept only where the window is full.  The output rows
are the sequences themselves, so their volume is inherent to the operator;
nothing is collected per series or on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.windows import CHUNK_ROWS, by_chunk, last_n_rows, series_window


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def vector(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def sliding_sequences(df: DataFrame, feature_cols: Sequence[str], length: int, keys="Ticker",
                      order="Date", target: str | None = "target", meta: bool = True) -> DataFrame:
    """One row per full window: keys, end date (``meta``), ``X`` =
    array of ``length`` feature vectors, ``y`` = target of the last row.
    Series shorter than ``length`` yield nothing."""
    w = series_window(keys, order)
    v = vector(feature_cols)
    steps = [F.lag(v, k).over(w) for k in range(length - 1, 0, -1)] + [v]
    first = F.lag(F.lit(1), length - 1).over(w)
    cols = [F.col(k) for k in _list(keys)]
    if meta:
        cols += [F.col(o) for o in _list(order)]
    cols.append(F.array(*steps).alias("X"))
    if target:
        cols.append(F.col(target).cast("double").alias("y"))
    return df.select(*cols, first.alias("_full")).where(F.col("_full").isNotNull()).drop("_full")


def hash_order(seed: int, key_cols: Sequence[str]) -> Column:
    """A seeded, partition-independent random order: the MD5 of seed and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]).cast("binary"))


def smallest_hashes(df: DataFrame, n: int, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """The ``n`` rows of smallest hash.  Rows are counted per hash prefix (65,536 counters
    reach the driver); all prefixes below the one where ``n`` is reached are kept by a plain
    filter, and only that one prefix is sorted."""
    h = hash_order(seed, key_cols)
    prefix = F.substring(h, 1, 4)
    counts = {r["p"]: r["n"] for r in df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = 0
    for p in sorted(counts):
        if total + counts[p] > n:
            edge = df.where(prefix == p).withColumn("_h", h).orderBy("_h", *key_cols).limit(n - total).drop("_h")
            return df.where(prefix < p).unionByName(edge)
        total += counts[p]
    return df


def capped(seqs: DataFrame, max_samples: int, seed: int = 42, keys="Ticker", order="Date") -> DataFrame:
    """at most ``max_samples`` sequences to fit on, spread by hash over all series (a bound
    on the rows of a fit, not on those that are scored)."""
    return smallest_hashes(seqs, max_samples, seed, _list(keys) + _list(order))


def sample_rows(df: DataFrame, n: int, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """a fixed-size, seeded sample, the same for any partitioning."""
    return smallest_hashes(df, n, seed, key_cols)


def sample_positions(seqs: DataFrame, rate: float, seed: int, keys="Ticker", order="Date") -> DataFrame:
    """per series, ``floor(n * rate)`` sequence positions without
    replacement (smallest hashes), original order kept."""
    k = _list(keys)
    r = F.row_number().over(Window.partitionBy(*k).orderBy(hash_order(seed, k + _list(order))))
    n = F.count(F.lit(1)).over(Window.partitionBy(*k))
    return (seqs.withColumn("_r", r).withColumn("_n", n)
            .where(F.col("_r") <= F.floor(F.col("_n") * F.lit(rate)))
            .drop("_r", "_n"))


def latest_sequence(df: DataFrame, feature_cols: Sequence[str], length: int, keys="Ticker",
                    order="Date") -> DataFrame:
    """The most recent full sequence of every series (scoring input), from its last
    ``length`` rows only."""
    k, o = _list(keys), _list(order)
    rows = last_n_rows(df, length, keys, order).select(
        *k, F.struct(*[F.col(x) for x in o]).alias("_at"), vector(feature_cols).alias("_v"))
    seqs = rows.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_s"))
    last = F.element_at("_s", -1)["_at"]
    return seqs.where(F.size("_s") == length).select(*k, *[last[x].alias(x) for x in o],
                                                     F.transform("_s", lambda s: s["_v"]).alias("X"))


def sequences_with_horizon(df: DataFrame, feature_cols: Sequence[str], length: int, horizon: int = 1,
                           keys="Ticker", order="Date", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``X`` = rows t-L+1..t, ``Y`` = rows t+1..t+h (all features);
    n-L-h+1 sequences per series.  With h = 1 ``Y`` is the next vector (and
    a scalar for one feature).  A series with L + h > n fails the job.
    Series are cut into chunks with halos, so one of any length is split."""
    v = vector(feature_cols)

    def columns(w):
        xs = [F.lag(v, k).over(w) for k in range(length - 1, 0, -1)] + [v]
        ys = [F.lead(v, k).over(w) for k in range(1, horizon + 1)]
        y = (ys[0][0] if len(feature_cols) == 1 else ys[0]) if horizon == 1 else F.array(*ys)
        return [F.array(*xs).alias("X"), y.alias("Y")]

    long_enough = F.when(F.col("_n") >= length + horizon, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"a sequence of {length} and a horizon of {horizon} need a longer series")))
    full = (F.col("_pos") >= length - 1) & (F.col("_pos") < F.col("_n") - horizon)
    return by_chunk(df, columns, keys, order, length - 1, horizon, chunk_rows, long_enough & full)


def pad(seq, max_length: int, padding: str = "pre", value=0.0, fail_longer: bool = True) -> Column:
    """Pad an array to ``max_length`` with ``value`` before ('pre') or
    after ('post'); longer arrays fail the job (they are not cut)."""
    a = F.col(seq) if isinstance(seq, str) else seq
    filler = F.array_repeat(F.lit(value), F.greatest(F.lit(max_length) - F.size(a), F.lit(0)))
    out = F.concat(filler, a) if padding == "pre" else F.concat(a, filler)
    if fail_longer:
        out = F.when(F.size(a) <= max_length, out).otherwise(
            F.raise_error(F.lit(f"sequence longer than max_length ({max_length})")))
    return out


def pad_vectors(seq, max_length: int, width: int, padding: str = "pre", value=0.0) -> Column:
    """J10 for sequences of vectors: the filler is a vector of ``width`` values."""
    a = F.col(seq) if isinstance(seq, str) else seq
    vec = F.array_repeat(F.lit(float(value)), width)
    filler = F.array_repeat(vec, F.greatest(F.lit(max_length) - F.size(a), F.lit(0)))
    out = F.concat(filler, a) if padding == "pre" else F.concat(a, filler)
    return F.when(F.size(a) <= max_length, out).otherwise(
        F.raise_error(F.lit(f"sequence longer than max_length ({max_length})")))


def truncate(seq, max_length: int) -> Column:
    """Keep the first ``max_length`` steps."""
    a = F.col(seq) if isinstance(seq, str) else seq
    return F.slice(a, 1, max_length)


def flatten_sequence(seq) -> Column:
    """(L, F) -> L*F vector."""
    return F.flatten(F.col(seq) if isinstance(seq, str) else seq)


def sequence_value_stats(seqs: DataFrame, col: str = "X", groups=()) -> DataFrame:
    """NaN / inf counts and min / max / mean / population std over every
    cell of every sequence (cells exploded inside the task, then one
    partially aggregated pass)."""
    g = [groups] if isinstance(groups, str) else list(groups)
    cells = seqs.select(*g, F.explode(F.flatten(F.col(col))).alias("v"))
    v = F.col("v")
    finite = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    return cells.groupBy(*g).agg(F.count(F.lit(1)).alias("cells"),
                                 F.count_if(F.isnan(v)).alias("nan"),
                                 F.count_if(F.abs(v) == F.lit(float("inf"))).alias("inf"),
                                 F.min(finite).alias("min"), F.max(finite).alias("max"),
                                 F.avg(finite).alias("mean"), F.stddev_pop(finite).alias("std"))
