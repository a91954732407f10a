"""Running sums, positions, fills and order statistics over large groups, range by range.

A window partitioned by a group of few values (a split, one hot series, or
nothing) puts a whole group into one task.  Here the rows are partitioned by
range of (group, order) and written once; aggregates per range are a small
table (one row per group and range), whose running totals are the offsets of
the ranges; the windows themselves run inside each range.  Equal rows of
(group, order) are in one range, so nothing depends on how ties fall.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def _columns(order) -> list[Column]:
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return [F.col(c) if isinstance(c, str) else c for c in order]


class Ranges:
    """``df`` written in ranges of (groups, order)."""

    def __init__(self, df: DataFrame, groups: Sequence[str], order):
        self.groups, self.order, self.columns = list(groups), _columns(order), df.columns
        self.rows = materialize(df.repartitionByRange(*[F.col(g) for g in self.groups], *self.order)
                                .withColumn("_range", F.spark_partition_id()))
        self.keys = [*self.groups, "_range"]
        self.within = Window.partitionBy(*self.keys).orderBy(*self.order)
        self.earlier = Window.partitionBy(*(self.groups or [F.lit(0)])).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)
        self.whole = Window.partitionBy(*(self.groups or [F.lit(0)]))

    def per_range(self, *aggregates: Column) -> DataFrame:
        """One row per group and range."""
        return self.rows.groupBy(*self.keys).agg(*aggregates)

    def join(self, rows: DataFrame, offsets: DataFrame) -> DataFrame:
        """Offsets (keys and more columns) to the rows of their range."""
        names = {k: f"_k{i}" for i, k in enumerate(self.keys)}
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        return rows.join(offsets.withColumnsRenamed(names), same).drop(*names.values())


def running_sums(df: DataFrame, groups: Sequence[str], order, sums: Sequence[str]) -> DataFrame:
    """``df`` with, for each column c of ``sums``, ``cum_c`` (its sum up to and with the
    row, in ``order`` within the group) and ``all_c`` (the group's sum); nulls count 0."""
    r = Ranges(df, groups, order)
    zero = lambda c: F.coalesce(c, F.lit(0))
    per = r.per_range(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    offsets = per.select(*r.keys, *[zero(F.sum(f"_s_{c}").over(r.earlier)).alias(f"_off_{c}") for c in sums],
                         *[zero(F.sum(f"_s_{c}").over(r.whole)).alias(f"all_{c}") for c in sums])
    up_to = r.within.rowsBetween(Window.unboundedPreceding, 0)
    inside = r.rows.select("*", *[zero(F.sum(c).over(up_to)).alias(f"_in_{c}") for c in sums])
    return r.join(inside, offsets).select(
        *[F.col(f"`{c}`") for c in r.columns],
        *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in sums], *[f"all_{c}" for c in sums])


def positions(df: DataFrame, groups: Sequence[str], order) -> DataFrame:
    """``df`` with ``_pos`` (0-based position in the group) and ``_n`` (the group's rows)."""
    r = Ranges(df, groups, order)
    per = r.per_range(F.count(F.lit(1)).alias("_c"))
    offsets = per.select(*r.keys, F.coalesce(F.sum("_c").over(r.earlier), F.lit(0)).alias("_off"),
                         F.sum("_c").over(r.whole).alias("_n"))
    numbered = r.rows.withColumn("_i", F.row_number().over(r.within) - 1)
    return r.join(numbered, offsets).select(*[F.col(f"`{c}`") for c in r.columns],
                                            (F.col("_off") + F.col("_i")).alias("_pos"), "_n")


def fill(df: DataFrame, col: str, groups: Sequence[str], order, default: float = 0.0) -> DataFrame:
    """Forward fill, back fill, then ``default`` for ``col`` (B1-B3), with the last value of
    earlier ranges carried over."""
    r = Ranges(df, groups, order)
    at = F.struct(*r.order)
    seen = F.col(col).isNotNull()
    per = r.per_range(F.max_by(F.when(seen, F.col(col)), F.when(seen, at)).alias("_last"),
                      F.min_by(F.when(seen, F.col(col)), F.when(seen, at)).alias("_first"))
    all_ranges = r.whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per.select(*r.keys, F.last("_last", ignorenulls=True).over(r.earlier).alias("_carried"),
                         F.first("_first", ignorenulls=True).over(all_ranges).alias("_start"))
    up_to = r.within.rowsBetween(Window.unboundedPreceding, 0)
    inside = r.rows.withColumn("_here", F.last(col, ignorenulls=True).over(up_to))
    filled = F.coalesce("_here", "_carried", "_start", F.lit(default)).alias(col)
    return r.join(inside, offsets).select(*[filled if c == col else F.col(f"`{c}`") for c in r.columns])


def carry(df: DataFrame, col: str, groups: Sequence[str], order) -> DataFrame:
    """Forward fill of ``col``, of any type, across ranges; nulls before the first value stay."""
    r = Ranges(df, groups, order)
    at = F.when(F.col(col).isNotNull(), F.struct(*r.order))
    offsets = r.per_range(F.max_by(F.col(col), at).alias("_last")).select(
        *r.keys, F.last("_last", ignorenulls=True).over(r.earlier).alias("_carried"))
    up_to = r.within.rowsBetween(Window.unboundedPreceding, 0)
    inside = r.rows.withColumn("_here", F.last(col, ignorenulls=True).over(up_to))
    filled = F.coalesce("_here", "_carried").alias(col)
    return r.join(inside, offsets).select(*[filled if c == col else F.col(f"`{c}`") for c in r.columns])


def quantiles(df: DataFrame, col: str, groups: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(groups, q, value): exact, linearly interpolated quantiles of the non-null ``col``."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*groups, col).agg(F.count(F.lit(1)).alias("n"))
    placed = running_sums(counts, groups, F.col(col), ["n"])
    at = lambda q: (F.col("all_n") - 1) * q
    first = F.col("cum_n") - F.col("n")
    holds = lambda p: (first <= p) & (p < F.col("cum_n"))
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    near = placed.select(*groups, col, "cum_n", "n", "all_n", F.explode(F.filter(
        wanted, lambda q: holds(F.floor(at(q))) | holds(F.ceil(at(q))))).alias("q"))
    low = F.max(F.when(holds(F.floor(at(F.col("q")))), F.col(col)))
    high = F.max(F.when(holds(F.ceil(at(F.col("q")))), F.col(col)))
    part = F.max(at(F.col("q")) - F.floor(at(F.col("q"))))
    return near.groupBy(*groups, "q").agg((low + (high - low) * part).alias("value"))


def with_group_values(df: DataFrame, stats: DataFrame, groups: Sequence[str], values: Sequence[str],
                      most: int = 1000) -> DataFrame:
    """``df`` with a few numbers per group as literals: no join, so no group meets in one task.

    ``stats`` has one row per group, at most ``most`` of them (else an error).
    """
    rows = stats.select(*groups, *values).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} groups")
    kinds = dict(stats.dtypes)
    for v in values:
        x = F.lit(None).cast(kinds[v])
        for r in rows:
            hit = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.lit(r[g])) for g in groups], F.lit(True))
            x = F.when(hit, F.lit(r[v]).cast(kinds[v])).otherwise(x)
        df = df.withColumn(v, x)
    return df
