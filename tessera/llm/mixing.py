"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of a source with
rate ``target / source size`` is due that many copies.  The whole part is
certain, the fractional part is a probability ``p`` that is rounded by the
pivotal method: two documents at a time, words of expected mass
(``size * p``) move from one to the other until one of them has probability
0 or 1.  The direction is drawn so that each probability keeps its mean, and
the mass of the pair never changes, so a source's taken words differ from
its target by less than the one document that is left at the end.

The pairs are arranged as a reduction tree: documents are dealt by hash to
blocks of about ``block`` rows, each block is folded in descending size
order and leaves one fractional document, and the residuals are dealt again
until one block per source is left.  That root block also gets a reserve of
about ``block`` documents held back by hash.  In the root each document, the
largest first, is paired with all smaller ones taken as one partner: it goes
to 0 or 1 at once, and the mass moves to or from the others in proportion to
their sizes, so what is left at the end is about one of the smallest
documents.  Only a move that the others cannot give or take is not drawn.

Only DataFrame functions are used.  Defined results: a null text has size 0;
a document of size 0 is never repeated (it keeps the whole part of its
rate); a null source is a source of its own, after all others; rows repeated
in full are numbered and rounded one by one, and are interchangeable; an
empty table gives an empty result.  Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import narrow, uniform, word_count

EPS = 1e-9


def source_targets(units: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(src, source, source_size, n, target) from (source, size) rows.

    Sources by code point, null last, take ``weights`` in turn and share the
    sum of all sizes by weight; no target exceeds ``cap`` times the source's
    size, and the excess is shared among the others by weight until none is
    above.  That fixed point is ``least(cap * size, level * weight)``: with
    sources ordered by ``cap * size / weight``, the level is the first one
    that, with all smaller ratios at their cap, lies at or under its own
    ratio.  Runs on one row per source.
    """
    per = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("src") - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("src", F.row_number().over(by_name)).withColumn("w", w)
           .withColumn("most", F.lit(float(cap)) * F.col("source_size")))
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    per = per.withColumn("level", level)
    ratio = F.col("most") / F.col("w")
    settled = F.when(F.col("level") <= ratio * (1 + 1e-12), F.struct(ratio.alias("ratio"), "src", "level"))
    per = per.withColumn("settled", F.min(settled).over(everything)["level"])
    return per.select("src", "source", "source_size", "n",
                      F.least(F.col("most"), F.coalesce(F.col("settled") * F.col("w"), F.col("most"))).alias("target"))


def _step(seed: int):
    """One pivotal step of the fold: residual ``acc.r`` against the next unit ``x``."""
    def step(acc: Column, x: Column) -> Column:
        a = acc["r"]
        up = F.least(a["size"] - a["mass"], x["mass"])        # words that can move to a
        down = F.least(a["mass"], x["size"] - x["mass"])      # words that can move to x
        rises = uniform(a["key"], a["ord"], x["key"], x["ord"], F.lit(seed)) * (up + down) < down
        total = a["mass"] + x["mass"]
        a_ends = F.when(rises, a["size"] - a["mass"] <= x["mass"]).otherwise(a["mass"] <= x["size"] - x["mass"])
        ended = F.when(a_ends, a).otherwise(x)
        left = F.when(a_ends, x).otherwise(a)
        full = a_ends == rises                                # the ended unit went to 1, not 0
        mass = F.greatest(F.lit(0.0), F.when(full, total - ended["size"]).otherwise(total))
        return F.struct(
            left.withField("mass", F.least(mass, left["size"].cast("double"))).alias("r"),
            F.concat(acc["done"], F.array(ended.withField("mass", full.cast("double")))).alias("done"))
    return step


def _fold(blocks: DataFrame, seed: int) -> DataFrame:
    """(src, block, unit) rows -> (src, block, r, done) with one residual per block."""
    first = F.element_at("u", 1)
    none_yet = F.slice("u", 1, 0)
    folded = F.aggregate(F.slice("u", 2, F.size("u")), F.struct(first.alias("r"), none_yet.alias("done")), _step(seed))
    return (blocks.groupBy("src", "block").agg(F.array_sort(F.collect_list("unit")).alias("u"))
            .select("src", "block", folded.alias("f")).select("src", "block", "f.r", "f.done"))


def _settle(blocks: DataFrame, seed: int) -> DataFrame:
    """(src, unit) rows of the root blocks -> (src, done) with every unit at 0 or 1."""
    def step(acc: Column, x: Column) -> Column:
        p = x["mass"] / x["size"] + acc["shift"]
        left, rest = acc["left"], acc["rest"] - x["size"]             # words to take, words to come
        can_take, can_leave = x["size"] <= left, left <= rest
        drawn = uniform(x["key"], x["ord"], F.lit(seed)) < p
        taken = F.when(can_take & can_leave, drawn).when(can_take | can_leave, can_take) \
            .otherwise(x["size"] - left < left - rest)
        moved = F.when(taken, F.lit(1.0)).otherwise(F.lit(0.0)) - p
        shift = F.when(rest > 0, acc["shift"] - moved * x["size"] / rest).otherwise(F.lit(0.0))
        return F.struct(shift.alias("shift"),
                        (left - F.when(taken, x["size"]).otherwise(F.lit(0))).alias("left"), rest.alias("rest"),
                        F.concat(acc["done"], F.array(x.withField("mass", taken.cast("double")))).alias("done"))

    zero = F.lit(0.0)
    total = lambda f: F.aggregate("u", zero, lambda a, x: a + x[f].cast("double"))
    start = F.struct(zero.alias("shift"), total("mass").alias("left"), total("size").alias("rest"),
                     F.slice("u", 1, 0).alias("done"))
    return (blocks.groupBy("src").agg(F.array_sort(F.collect_list("unit")).alias("u"))
            .select("src", F.aggregate("u", start, step)["done"].alias("done")))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, block: int = 256,
                seed: int = 17) -> DataFrame:
    """Copies of every row of ``docs`` (doc_id, text, source).

    Returns (doc_id, key, ord, size, source, source_size, target, copies);
    ``key`` is the hash of (doc_id, source, text), ``ord`` numbers rows that
    are equal in all three.  Folded blocks hold about ``block`` rows.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64("doc_id", "source", "text").alias("key"))
    same = rows.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("m"))
    units = narrow(same.select("doc_id", "source", "size", "key",
                                    F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("ord")))
    targets = narrow(source_targets(units, weights, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    base = F.floor(F.col("rate") + EPS)
    frac = F.greatest(F.lit(0.0), F.col("rate") - F.col("base"))
    with_p = (units.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
              .withColumn("rate", rate).withColumn("base", base)
              .withColumn("mass", F.when(frac < EPS, F.lit(0.0)).otherwise(F.col("size") * frac)))
    fields = ["key", "ord", "doc_id", "size", "mass"]
    unit = F.struct((-F.col("size")).alias("by_size"), F.xxhash64("key", "ord", F.lit(seed)).alias("by_hash"),
                    *fields)
    tagged = with_p.select("src", "n", "mass", unit.alias("unit"),
                           uniform("key", "ord", F.lit(seed + 1)).alias("u"),
                           F.xxhash64("key", "ord", F.lit(seed + 2)).alias("deal"))
    settled = tagged.where(F.col("mass") == 0)
    open_ = tagged.where(F.col("mass") > 0)
    held = F.col("u") * F.col("n") < block
    n_blocks = F.ceil(F.col("n") / F.lit(float(block)))
    level = open_.where(~held).select("src", F.pmod("deal", n_blocks).alias("block"), "unit")
    reserve = open_.where(held).select("src", "unit")

    largest = targets.agg(F.max("n")).first()[0] or 0      # one number: how deep the tree is
    done, width, depth = [settled.select("src", "unit")], block, 0
    while -(-largest // width) > 1:
        folded = narrow(_fold(level, seed + 10 + depth))
        done.append(folded.select("src", F.explode("done").alias("unit")))
        width, depth = width * block, depth + 1
        groups = F.ceil(F.col("n") / F.lit(float(width)))
        level = (folded.join(targets.select("src", "n"), "src")
                 .select("src", F.pmod("block", groups).alias("block"), F.col("r").alias("unit")))
    root = narrow(_settle(level.select("src", "unit").unionByName(reserve), seed + 3))
    done.append(root.select("src", F.explode("done").alias("unit")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = out.select("src", "unit.*").join(targets, "src").withColumn("rate", rate)
    return out.select("doc_id", "key", "ord", "size", "source", "source_size", "target",
                      (F.floor(F.col("rate") + EPS) + F.col("mass")).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it."""
    decided = mix_sources(docs, **options).select(F.col("key").alias("_k"), F.col("ord").alias("_o"), "copies") \
        .where(F.col("copies") > 0)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.xxhash64("doc_id", "source", "text").alias("key"))
    numbered = row.withColumn("ord", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    taken = numbered.join(decided, (F.col("key") == F.col("_k")) & (F.col("ord") == F.col("_o")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
