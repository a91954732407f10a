"""Evaluation of binary forecasts.

Input: a prediction table with an ``Actual`` 0/1 column, a ``Probability``
score and optional group keys (split, Ticker, model ...).

Scale notes.  Everything is a grouped aggregate (partial aggregation before
the shuffle).  Curves (ROC, PR) and order statistics first collapse the table
to a *score histogram*, one row per (group, distinct score), and cumulate it
range by range (``ranges.running_sums``), so neither a group nor the number of
distinct scores has to fit a task.  No table is cross-joined with thresholds:
a score is assigned to its threshold bucket arithmetically, and statistics of
a few groups are applied as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import quantiles, running_sums, with_group_values

ACT, PROB, PRED = "Actual", "Probability", "Predicted"


def _g(groups) -> list[str]:
    return [groups] if isinstance(groups, str) else list(groups or [])


def zdiv(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (scikit-learn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(pred: Column, actual: Column | None = None) -> list[Column]:
    actual = F.col(ACT) if actual is None else actual
    return [F.count_if((pred == 1) & (actual == 1)).alias("tp"),
            F.count_if((pred == 1) & (actual == 0)).alias("fp"),
            F.count_if((pred == 0) & (actual == 0)).alias("tn"),
            F.count_if((pred == 0) & (actual == 1)).alias("fn")]


def with_rates(df: DataFrame) -> DataFrame:
    """accuracy / precision / recall / F1 from tp fp tn fn columns (K5, K6)."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    precision = zdiv(tp, tp + fp)
    recall = zdiv(tp, tp + fn)
    return df.select("*",
                     zdiv(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                     precision.alias("precision"), recall.alias("recall"),
                     zdiv(2 * tp, 2 * tp + fp + fn).alias("f1"))


def binary_metrics(df: DataFrame, groups=(), threshold: float = 0.5, inclusive: bool = False,
                   score: str = PROB) -> DataFrame:
    """K5-K7: confusion counts and rates per group at one threshold."""
    s = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    pred = (s >= threshold if inclusive else s > threshold).cast("int")
    return with_rates(df.groupBy(*_g(groups)).agg(*confusion_counts(pred)))


def confusion_matrix(df: DataFrame, groups=(), pred: str = PRED) -> DataFrame:
    """K7 as rows: (groups, Actual, Predicted, n)."""
    return df.groupBy(*_g(groups), ACT, pred).agg(F.count(F.lit(1)).alias("n"))


def class_accuracy(df: DataFrame, groups=(), pred: str = PRED) -> DataFrame:
    """K8: accuracy within each actual class (class recall), in percent."""
    return (df.groupBy(*_g(groups), ACT)
            .agg(F.count(F.lit(1)).alias("support"),
                 (F.avg((F.col(pred) == F.col(ACT)).cast("double")) * 100).alias("class_accuracy")))


def classification_report(df: DataFrame, groups=(), pred: str = PRED) -> DataFrame:
    """K9: per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages -- one aggregation, then a projection to rows."""
    g = _g(groups)
    p, a = F.col(pred), F.col(ACT)
    agg = df.groupBy(*g).agg(*confusion_counts(p, a))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    # class 1 is "positive"; class 0 swaps the roles
    p1, r1 = zdiv(tp, tp + fp), zdiv(tp, tp + fn)
    p0, r0 = zdiv(tn, tn + fn), zdiv(tn, tn + fp)
    f1_1, f1_0 = zdiv(2 * p1 * r1, p1 + r1), zdiv(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    acc = zdiv(tp + tn, n)

    def row(label, prec, rec, f1, sup):
        return F.struct(F.lit(label).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), sup.cast("bigint").alias("support"))
    rows = F.array(row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
                   row("accuracy", acc, acc, acc, n),
                   row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
                   row("weighted avg", zdiv(p0 * s0 + p1 * s1, n), zdiv(r0 * s0 + r1 * s1, n),
                       zdiv(f1_0 * s0 + f1_1 * s1, n), n))
    return agg.select(*g, F.inline(rows))


def score_histogram(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """(groups, score, pos, neg): the sufficient statistic of every curve.  A row without a score
    (NULL or NaN) takes no part in any curve, scan or metric."""
    a = F.col(ACT)
    return (df.where(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(*_g(groups), score)
            .agg(F.count_if(a == 1).alias("pos"), F.count_if(a == 0).alias("neg")))


def _cumulated(df: DataFrame, g: list[str], score: str) -> DataFrame:
    """(groups, threshold, pos, neg, tps, fps, P, N) per distinct score, descending."""
    h = running_sums(score_histogram(df, g, score), g, F.col(score).desc(), ["pos", "neg"])
    return h.select(*g, F.col(score).alias("threshold"), "pos", "neg", F.col("cum_pos").alias("tps"),
                    F.col("cum_neg").alias("fps"), F.col("all_pos").alias("P"), F.col("all_neg").alias("N"))


def roc_curve(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, descending, plus the
    (0, 0) point with threshold NULL (= +inf).  Ties share one point."""
    g = _g(groups)
    pts = _cumulated(df, g, score)
    origin = (pts.groupBy(*g).agg(F.max("P").alias("P"), F.max("N").alias("N"))
              .select(*g, F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("bigint").alias("tps"),
                      F.lit(0).cast("bigint").alias("fps"), "P", "N"))
    allp = pts.select(*g, "threshold", "tps", "fps", "P", "N").unionByName(origin)
    return allp.select(*g, "threshold", "tps", "fps",
                       F.try_divide(F.col("fps"), F.col("N")).alias("fpr"),
                       F.try_divide(F.col("tps"), F.col("P")).alias("tpr"))


def roc_auc(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """Exact area under the ROC curve (trapezoids; ties handled); NULL
    when a group has a single class.  Each point's trapezoid needs only its
    own counts: width neg / N, mean height (2 tps - pos) / 2P."""
    g = _g(groups)
    area = F.try_divide(F.col("neg") * (2 * F.col("tps") - F.col("pos")), 2.0 * F.col("P") * F.col("N"))
    return _cumulated(df, g, score).select(*g, area.alias("a")).groupBy(*g).agg(F.sum("a").alias("auc"))


def pr_curve(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """Precision / recall / F1 (= 2pr/(p+r+1e-10)) at every distinct score;
    recall is 1 for a group without positives; the end point (precision 1,
    recall 0) has threshold NULL."""
    g = _g(groups)
    pts = _cumulated(df, g, score)
    prec = F.try_divide(F.col("tps"), F.col("tps") + F.col("fps"))
    rec = F.coalesce(F.try_divide(F.col("tps"), F.col("P")), F.lit(1.0))
    body = pts.select(*g, "threshold", prec.alias("precision"), rec.alias("recall"))
    end = (pts.groupBy(*g).agg(F.lit(1).alias("_one"))
           .select(*g, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall")))
    out = body.unionByName(end)
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", 2 * p * r / (p + r + F.lit(1e-10)))


def threshold_points(n: int = 81, start: float = 0.1, step: float = 0.01) -> list[float]:
    """Thresholds round(start + step*i, 2) -- fixed value of the scan (0.10 .. 0.90)."""
    return [round(start + step * i, 2) for i in range(n)]


def threshold_scan(df: DataFrame, groups=(), n: int = 81, start: float = 0.1, step: float = 0.01,
                   score: str = PROB) -> DataFrame:
    """Metrics of ``score >= t`` for each of the ``n`` thresholds.

    Each distinct score goes to the bucket of the largest threshold <= score
    (computed arithmetically, corrected by exact comparisons), then counts
    are cumulated over the <= n+1 buckets.  No cross join.
    """
    g = _g(groups)
    h = score_histogram(df, g, score)
    s = F.col(score)

    def t(j):
        return F.round(F.lit(start) + F.lit(step) * j, 2)
    i0 = F.floor((s - F.lit(start)) / F.lit(step)).cast("int")
    i = (F.when(s >= t(i0 + 1), i0 + 1).when(s >= t(i0), i0).otherwise(i0 - 1))
    i = F.least(F.greatest(i, F.lit(-1)), F.lit(n - 1))
    b = h.groupBy(*g, i.alias("i")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ids = F.sequence(F.lit(0), F.lit(n - 1))
    # cumulate from the top bucket down: tp(t_j) = positives with bucket >= j
    totals = b.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                               F.map_from_entries(F.collect_list(F.struct("i", F.struct("pos", "neg"))))
                               .alias("_m"))
    grid = totals.select(*g, "P", "N", "_m", F.explode(ids).alias("j"))
    pos_at = F.aggregate(F.filter(F.map_keys("_m"), lambda k: k >= F.col("j")), F.lit(0).cast("bigint"),
                         lambda acc, k: acc + F.element_at("_m", k)["pos"])
    neg_at = F.aggregate(F.filter(F.map_keys("_m"), lambda k: k >= F.col("j")), F.lit(0).cast("bigint"),
                         lambda acc, k: acc + F.element_at("_m", k)["neg"])
    out = grid.select(*g, t(F.col("j")).alias("threshold"), pos_at.alias("tp"), neg_at.alias("fp"), "P", "N")
    out = out.select(*g, "threshold", "tp", "fp", (F.col("N") - F.col("fp")).alias("tn"),
                     (F.col("P") - F.col("tp")).alias("fn"))
    return with_rates(out)


def best_f1_threshold(scan: DataFrame, groups=()) -> DataFrame:
    """K13 choice: the threshold of maximal F1, the lowest one among ties."""
    g = _g(groups)
    return scan.groupBy(*g).agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"),
                                F.max("f1").alias("f1"))


def youden_threshold(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """ROC threshold maximising tpr - fpr (the highest threshold among ties)."""
    g = _g(groups)
    c = roc_curve(df, g, score).where(F.col("threshold").isNotNull())
    j = F.col("tpr") - F.col("fpr")
    return c.groupBy(*g).agg(F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("threshold"),
                             F.max(j).alias("youden_j"))


def pr_best_threshold(df: DataFrame, groups=(), score: str = PROB) -> DataFrame:
    """PR-curve threshold of maximal F1 (the lowest threshold among ties);
    0.5 when the best point is the curve's end point."""
    g = _g(groups)
    c = pr_curve(df, g, score)
    key = F.struct(F.col("f1"), -F.coalesce(F.col("threshold"), F.lit(2.0)))
    best = c.groupBy(*g).agg(F.max_by("threshold", key).alias("t"), F.max("f1").alias("f1"))
    return best.select(*g, F.coalesce("t", F.lit(0.5)).alias("threshold"), "f1")


def metrics_at(df: DataFrame, thresholds: dict, groups=(), score: str = PROB,
               inclusive: bool = True) -> DataFrame:
    """Metrics of several named thresholds in one pass over the table."""
    g = _g(groups)
    s, a = F.col(score), F.col(ACT)
    aggs = []
    for name, t in thresholds.items():
        p = (s >= F.lit(t)) if inclusive else (s > F.lit(t))
        aggs += [F.count_if(p & (a == 1)).alias(f"{name}|tp"), F.count_if(p & (a == 0)).alias(f"{name}|fp"),
                 F.count_if(~p & (a == 0)).alias(f"{name}|tn"), F.count_if(~p & (a == 1)).alias(f"{name}|fn")]
    wide = df.groupBy(*g).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("method"), F.lit(float(t)).alias("threshold"),
                              *[F.col(f"`{name}|{c}`").alias(c) for c in ("tp", "fp", "tn", "fn")])
                     for name, t in thresholds.items()])
    return with_rates(wide.select(*g, F.inline(rows)))


def per_group_performance(df: DataFrame, key: str = "Ticker", groups=(), pred: str = PRED) -> DataFrame:
    """Samples, accuracy, precision, recall, F1 per series."""
    g = _g(groups) + [key]
    return with_rates(df.groupBy(*g).agg(*confusion_counts(F.col(pred)))).select(
        *g, (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("samples"),
        "accuracy", "precision", "recall", "f1")


def threshold_candidates(df: DataFrame, score: str = PROB) -> dict[str, float]:
    """The thresholds of the four methods on one table (three scalars to the driver)."""
    return {"default": 0.5, "best F1": best_f1_threshold(threshold_scan(df, score=score)).first()["threshold"],
            "Youden": youden_threshold(df, score=score).first()["threshold"],
            "PR curve": pr_best_threshold(df, score=score).first()["threshold"]}


def default_vs_best(val: DataFrame, test: DataFrame, score: str = PROB) -> DataFrame:
    """(metric, default, optimal, improvement, improvement_pct) on ``test`` at 0.5 (strict)
    and at the method with the best F1 on ``val`` (inclusive; the first of equals)."""
    methods = threshold_candidates(val, score)
    f1 = {r["method"]: r["f1"] for r in metrics_at(val, methods, score=score).collect()}
    best = max(methods, key=lambda m: f1[m])               # max keeps the first of equals
    s = F.col(score)
    both = test.agg(*[c.alias(f"d_{n}") for c, n in zip(confusion_counts((s > 0.5).cast("int")), ("tp", "fp", "tn", "fn"))],
                    *[c.alias(f"o_{n}") for c, n in zip(confusion_counts((s >= F.lit(methods[best])).cast("int")),
                                                        ("tp", "fp", "tn", "fn"))])
    side = lambda x, name: F.struct(F.lit(name).alias("side"), *[F.col(f"{x}_{n}").alias(n) for n in ("tp", "fp", "tn", "fn")])
    rates = with_rates(both.select(F.inline(F.array(side("d", "default"), side("o", "optimal")))))
    names = ["accuracy", "precision", "recall", "f1"]
    long = rates.unpivot(["side"], names, "metric", "v")
    out = long.groupBy("metric").agg(F.max(F.when(F.col("side") == "default", F.col("v"))).alias("default"),
                                     F.max(F.when(F.col("side") == "optimal", F.col("v"))).alias("optimal"))
    gain = F.col("optimal") - F.col("default")
    return out.select("metric", "default", "optimal", gain.alias("improvement"),
                      F.try_divide(gain * 100, F.col("default")).alias("improvement_pct"))


def top_bottom(df: DataFrame, by: str, k: int, key: str = "Ticker", groups=()) -> DataFrame:
    """the best and the worst ``k`` rows per group by ``by`` (ties broken by key).

    Two full lists: a row that is among both has a row in each."""
    g = _g(groups)
    sides = []
    for side, order in (("best", F.col(by).desc()), ("worst", F.col(by).asc())):
        r = F.row_number().over(Window.partitionBy(*g).orderBy(order, F.col(key)))
        sides.append(df.select("*", r.alias("_r")).where(F.col("_r") <= k).drop("_r")
                     .select("*", F.lit(side).alias("rank_side")))
    return sides[0].unionByName(sides[1])


def model_results(scores: DataFrame, model: str = "model", split: str = "split", score: str = "p") -> DataFrame:
    """Per model and split: accuracy (percent), per-class accuracies and log loss."""
    from tessera.operators.losses import bce
    y, p = F.col(ACT), F.col(score)
    return scores.groupBy(model, split).agg(
        (F.avg(((p > 0.5).cast("int") == y).cast("double")) * 100).alias("acc"),
        (F.avg(F.when(y == 0, (p <= 0.5).cast("double"))) * 100).alias("acc0"),
        (F.avg(F.when(y == 1, (p > 0.5).cast("double"))) * 100).alias("acc1"),
        bce(p, y.cast("double")).alias("loss"))


def model_leaderboard(results: DataFrame) -> DataFrame:
    """K21, training form: validation next to training accuracy, class balance and gap."""
    v = results.where(F.col("split") == "val").drop("split")
    t = results.where(F.col("split") == "train").select("model", F.col("acc").alias("tacc"))
    out = v.join(t, "model").select(
        "model", F.col("acc").alias("val_accuracy"), F.col("tacc").alias("train_accuracy"),
        F.col("acc0").alias("class0_accuracy"), F.col("acc1").alias("class1_accuracy"),
        (F.lit(100.0) - F.abs(F.col("acc0") - F.col("acc1"))).alias("balance"),
        (F.col("tacc") - F.col("acc")).alias("generalisation_gap"))
    return out.orderBy(F.col("val_accuracy").desc(), "model")


def model_losses(results: DataFrame) -> DataFrame:
    """K21, evaluation form: models ranked by validation loss, with the test loss and accuracies."""
    v = results.where(F.col("split") == "val").select("model", F.col("loss").alias("val_loss"),
                                                      F.col("acc").alias("val_accuracy"))
    t = results.where(F.col("split") == "test").select("model", F.col("loss").alias("test_loss"),
                                                       F.col("acc").alias("test_accuracy"))
    rank = F.row_number().over(Window.orderBy("val_loss", "model"))          # one row per model
    return v.join(t, "model").withColumn("rank", rank).orderBy("rank")


def compare_results(results: DataFrame, left: str = "val", right: str = "test") -> DataFrame:
    """Two model-result tables joined on the model, with the change."""
    a = results.where(F.col("split") == left).select("model", F.col("acc").alias(f"{left}_accuracy"))
    b = results.where(F.col("split") == right).select("model", F.col("acc").alias(f"{right}_accuracy"))
    return a.join(b, "model").withColumn("accuracy_change", F.col(f"{right}_accuracy") - F.col(f"{left}_accuracy"))


def prediction_table(df: DataFrame, order: str = "Date", pred: str = PRED) -> DataFrame:
    """Correct flag and calendar parts."""
    return df.select("*", (F.col(ACT) == F.col(pred)).cast("int").alias("Correct"),
                     F.year(order).alias("Year"), F.month(order).alias("Month"),
                     F.quarter(order).alias("Quarter"))


def accuracy_by(df: DataFrame, part: str, groups=()) -> DataFrame:
    """Mean correctness and count per calendar part."""
    return df.groupBy(*_g(groups), part).agg(F.avg("Correct").alias("Accuracy"),
                                              F.count(F.lit(1)).alias("Count"))


def summary_of(df: DataFrame, col: str, groups=(), sample: bool = True) -> DataFrame:
    """D8 (sample std) / D9 (population std + median): summary statistics."""
    g = _g(groups)
    std = F.stddev_samp(col) if sample else F.stddev_pop(col)
    out = df.groupBy(*g).agg(F.avg(col).alias("mean"), std.alias("std"), F.min(col).alias("min"),
                             F.max(col).alias("max"))
    if sample:
        return out
    middle = quantiles(df, col, g, [0.5]).withColumnRenamed("value", "median")
    return with_group_values(out, middle, g, ["median"])


PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)  # fixed values


def percentiles(df: DataFrame, col: str, groups=(), qs: Sequence[int] = PERCENTILES) -> DataFrame:
    """Exact linearly interpolated percentiles, one row per level."""
    g = _g(groups)
    found = quantiles(df, col, g, [q / 100.0 for q in qs])
    return found.select(*g, F.round(F.col("q") * 100).cast("int").alias("pct"), "value")


BUCKET_EDGES = (0.1, 0.3, 0.5, 0.7, 0.9)  # fixed values: <.1, .1-.3, ..., >=.9


def bucket_counts(df: DataFrame, col: str = PROB, groups=()) -> DataFrame:
    """Counts in the fixed probability buckets."""
    x = F.col(col)
    label = F.lit(">=0.9")
    for lo, hi in reversed(list(zip((None,) + BUCKET_EDGES[:-1], BUCKET_EDGES))):
        cond = x < hi
        label = F.when(cond, F.lit(f"<{hi}" if lo is None else f"{lo}-{hi}")).otherwise(label)
    return df.groupBy(*_g(groups), label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def positives_at(df: DataFrame, thresholds=(0.1, 0.2, 0.3, 0.4, 0.5), col: str = PROB, groups=()) -> DataFrame:
    """Number and share of ``col > t`` for a few thresholds, one pass."""
    g = _g(groups)
    x = F.col(col)
    wide = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"),
                              *[F.count_if(x > F.lit(t)).alias(f"_p{i}") for i, t in enumerate(thresholds)])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_p{i}").alias("positives"),
                              (F.col(f"_p{i}") * 100.0 / F.col("_n")).alias("pct"))
                     for i, t in enumerate(thresholds)])
    return wide.select(*g, F.inline(rows))


def equal_width_histogram(df: DataFrame, col: str, bins: int, groups=(), by=()) -> DataFrame:
    """``bins`` equal-width bins between the column's min and max (last
    bin closed), counts per bin (and per ``by`` class)."""
    g, b = _g(groups), _g(by)
    rng = df.groupBy(*g).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = with_group_values(df, rng, g, ["_lo", "_hi"])
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return (j.groupBy(*g, *b, idx.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi")))


def median_threshold_predictions(df: DataFrame, col: str = PROB, groups=()) -> DataFrame:
    """t = median score (per group); prediction = score > t."""
    g = _g(groups)
    middle = quantiles(df, col, g, [0.5]).withColumnRenamed("value", "median_threshold")
    return (with_group_values(df, middle, g, ["median_threshold"])
            .withColumn("Pred", (F.col(col) > F.col("median_threshold")).cast("int")))
