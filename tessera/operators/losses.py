"""Losses and normalisation over prediction tables.

Each loss is one aggregate over the table (partial aggregation per task);
per-row gradients are projections.  Batch statistics are grouped
aggregates keyed by a batch column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import clip, one_hot, sigmoid, softmax

# Clipping constants.
BCE_EPS = 1e-8
WEIGHTED_EPS = 1e-7
BN_EPS = 1e-5


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def mse(pred, target) -> Column:
    """L1: mean squared error (an aggregate expression)."""
    return F.avg(F.pow(_c(pred) - _c(target), 2))


def bce_terms(pred, target, from_logits: bool = False) -> Column:
    p = sigmoid(_c(pred)) if from_logits else clip(_c(pred), BCE_EPS, 1 - BCE_EPS)
    p = clip(p, BCE_EPS, 1 - BCE_EPS)
    y = _c(target)
    return -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))


def bce(pred, target, from_logits: bool = False) -> Column:
    """L2: binary cross-entropy from probabilities or logits, clipped at 1e-8."""
    return F.avg(bce_terms(pred, target, from_logits))


def weighted_focal_bce(pred, target, w0: float, w1: float, gamma: float = 0.0) -> Column:
    """L4: class-weighted BCE with optional focal factor (1 - pt)^gamma,
    clipped at 1e-7, averaged over rows (not weight-normalised)."""
    p = clip(_c(pred), WEIGHTED_EPS, 1 - WEIGHTED_EPS)
    y = _c(target)
    b = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    if gamma > 0:
        pt = F.when(y == 1, p).otherwise(F.lit(1.0) - p)
        b = F.pow(F.lit(1.0) - pt, F.lit(float(gamma))) * b
    w = F.when(y == 0, F.lit(float(w0))).otherwise(F.lit(float(w1)))
    return F.avg(w * b)


def softmax_ce_terms(logits, label, k: int) -> Column:
    """Per-row -sum(onehot * log(clip(softmax, 1e-8, 1)))."""
    sm = softmax(_c(logits))
    oh = one_hot(_c(label), k)
    return -F.aggregate(F.zip_with(oh, sm, lambda t, s: t * F.log(F.greatest(F.least(s, F.lit(1.0)), F.lit(BCE_EPS)))),
                        F.lit(0.0), lambda a, v: a + v)


def softmax_ce(logits, label, k: int) -> Column:
    """L3: softmax cross-entropy with one-hot targets, summed and divided by
    the number of rows."""
    return F.sum(softmax_ce_terms(logits, label, k)) / F.count(F.lit(1))


def gradients(df: DataFrame, pred: str, target: str, kind: str, n: int | None = None,
              from_logits: bool = False) -> DataFrame:
    """Per-row gradient of the mean loss w.r.t. the prediction, divided by
    the row count ``n`` (counted once when not given -- a scalar, no global
    window)."""
    if n is None:
        n = df.count()
    p, y = F.col(pred), F.col(target)
    nn = F.lit(float(n))
    if kind == "softmax_ce":            # a vector of logits and a class number: softmax - onehot
        g = F.transform(softmax(p), lambda s, i: (s - (i == y).cast("double")) / nn)
        return df.withColumn("grad", g)
    if kind == "mse":
        g = F.lit(2.0) * (p - y) / nn
    elif kind != "bce":
        raise ValueError(kind)
    elif from_logits:
        g = (sigmoid(p) - y) / nn
    else:
        pc = clip(clip(p, BCE_EPS, 1 - BCE_EPS), BCE_EPS, 1 - BCE_EPS)
        g = -(y / pc - (F.lit(1.0) - y) / (F.lit(1.0) - pc)) / nn
    return df.withColumn("grad", g)


def batchnorm_apply(x, mean: Sequence[float], var: Sequence[float], gamma: Sequence[float],
                    beta: Sequence[float], eps: float = BN_EPS) -> Column:
    """(x - mean) / sqrt(var + eps) * gamma + beta over a vector column."""
    a = _c(x)
    params = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(v)).alias("v"),
                                F.lit(float(g)).alias("g"), F.lit(float(b)).alias("b"))
                       for m, v, g, b in zip(mean, var, gamma, beta)])
    return F.zip_with(a, params, lambda xi, p: (xi - p["m"]) / F.sqrt(p["v"] + F.lit(eps)) * p["g"] + p["b"])


def vector_statistics(df: DataFrame, col: str) -> tuple[list[float], list[float]]:
    """Mean and population variance of each component of a vector column, in one pass
    (two numbers per component reach the driver)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    r = (df.select(array_to_vector(F.col(col)).alias("v"))
         .select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
         .select("s.mean", "s.variance", F.col("s.count").alias("n")).first())
    n = r["n"]
    return [float(m) for m in r["mean"]], [float(v) * (n - 1) / n for v in r["variance"]]


def batch_statistics(df: DataFrame, batch: str, features: Sequence[str]) -> DataFrame:
    """Per batch, per feature mean and population variance (long form)."""
    from tessera.operators.selection import long_format
    return (long_format(df, features, [batch]).groupBy(batch, "feature")
            .agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var"), F.count(F.lit(1)).alias("n")))


def batch_normalise(df: DataFrame, batch: str, features: Sequence[str], eps: float = BN_EPS) -> DataFrame:
    """Normalise every feature by its own batch mean / population variance
    (window per batch: the batch is the partition, no join)."""
    w = Window.partitionBy(batch)
    out = []
    for c in df.columns:
        if c in features:
            x = F.col(c).cast("double")
            out.append(((x - F.avg(x).over(w)) / F.sqrt(F.var_pop(x).over(w) + F.lit(eps))).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def running_statistics(stats: DataFrame, batch: str, momentum: float = 0.9,
                       init_mean: float = 0.0, init_var: float = 1.0) -> DataFrame:
    """Final running mean / variance after all batches in ``batch`` order,
    r = momentum * r + (1 - momentum) * b, in closed form as one weighted sum
    per feature: r_K = m^K r_0 + sum_i (1-m) m^(K-i) b_i."""
    w = Window.partitionBy("feature").orderBy(batch)
    k = F.count(F.lit(1)).over(Window.partitionBy("feature"))
    i = F.row_number().over(w)
    weight = F.lit(1.0 - momentum) * F.pow(F.lit(momentum), (k - i).cast("double"))
    decay = F.pow(F.lit(momentum), k.cast("double"))
    t = stats.select("feature", (weight * F.col("mean")).alias("wm"), (weight * F.col("var")).alias("wv"),
                     decay.alias("d"))
    return t.groupBy("feature").agg((F.first("d") * F.lit(init_mean) + F.sum("wm")).alias("running_mean"),
                                    (F.first("d") * F.lit(init_var) + F.sum("wv")).alias("running_var"))
