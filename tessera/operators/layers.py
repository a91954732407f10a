"""Layer forward passes as array-column expressions.

Inputs are ``array<double>`` (one channel) or ``array<array<double>>``
(steps x channels).  Weights are model parameters -- small literal arrays
whose size depends on the layer, never on the data.  Everything is a
JVM-side higher-order function (``transform`` / ``aggregate`` / ``zip_with``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, v: a + v)


def conv1d(x, weights: Sequence[Sequence[float]], bias: Sequence[float], stride: int = 1,
           padding: str = "valid") -> Column:
    """L8, one input channel: out[i][f] = sum_j xp[i*s + j] * W[j][f] + b[f],
    output length (n + 2*pad - k) // s + 1 for an input of any length n, zero
    padding on both sides.  An input shorter than the kernel fails the job.
    ``weights`` is k x filters."""
    k = len(weights)
    filters = len(bias)
    a = _c(x).cast("array<double>")
    n = F.size(a)
    # 'same' pads ((n-1)*s + k - n) // 2 zeros on each side
    pad = F.floor(((n - 1) * stride + k - n) / F.lit(2)).cast("int") if padding == "same" else F.lit(0)
    zeros = F.array_repeat(F.lit(0.0), pad)
    xp = F.concat(zeros, a, zeros)
    out_len = (F.floor((n + 2 * pad - k) / F.lit(stride)) + 1).cast("int")
    wcols = [F.array(*[F.lit(float(weights[j][f])) for j in range(k)]) for f in range(filters)]

    def at(i):
        win = F.slice(xp, i * stride + 1, k)
        return F.array(*[_sum(F.zip_with(win, wcols[f], lambda u, v: u * v)) + F.lit(float(bias[f]))
                         for f in range(filters)])
    return F.when(out_len >= 1, F.transform(F.sequence(F.lit(0), out_len - 1), at)).otherwise(
        F.raise_error(F.lit(f"input shorter than the kernel ({k})")))


def conv1d_channels(x, weights: Sequence[Sequence[Sequence[float]]], bias: Sequence[float], stride: int = 1,
                    padding: str = "valid") -> Column:
    """L8 over a sequence of vectors (steps x channels): ``weights`` is k x channels x filters,
    out[i][f] = sum_j sum_c xp[i*s + j][c] * W[j][c][f] + b[f], a sequence of filter vectors.  The
    geometry is that of ``conv1d``; a step of another width than the kernel's fails the job."""
    k, channels, filters = len(weights), len(weights[0]), len(bias)
    a = _c(x).cast("array<array<double>>")
    n = F.size(a)
    pad = F.floor(((n - 1) * stride + k - n) / F.lit(2)).cast("int") if padding == "same" else F.lit(0)
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), channels), pad)
    xp = F.concat(zeros, a, zeros)
    out_len = (F.floor((n + 2 * pad - k) / F.lit(stride)) + 1).cast("int")
    # a window flattened is one vector, a filter's kernel flattened the same way another
    kernels = [F.array(*[F.lit(float(weights[j][c][f])) for j in range(k) for c in range(channels)])
               for f in range(filters)]

    def at(i):
        win = F.flatten(F.slice(xp, i * stride + 1, k))
        return F.array(*[_sum(F.zip_with(win, kernel, lambda u, v: u * v)) + F.lit(float(b))
                         for kernel, b in zip(kernels, bias)])
    fits = F.forall(a, lambda v: F.size(v) == channels)
    return F.when(out_len < 1, F.raise_error(F.lit(f"input shorter than the kernel ({k})"))).when(
        fits, F.transform(F.sequence(F.lit(0), out_len - 1), at)).otherwise(
        F.raise_error(F.lit(f"the kernel takes {channels} channels")))


def _pooled(x, pool: int, stride: int | None, value) -> Column:
    """``value`` of each window; an input with fewer values than a window fails the job."""
    s = stride or pool
    a = _c(x)
    out_len = F.floor((F.size(a) - pool) / s).cast("int") + 1
    return F.when(F.size(a) >= pool, F.transform(F.sequence(F.lit(0), out_len - 1),
                                                 lambda i: value(F.slice(a, i * s + 1, pool)))).when(
        a.isNotNull(), F.raise_error(F.lit(f"input shorter than the pool ({pool})")))


def max_pool(x, pool: int, stride: int | None = None) -> Column:
    """(n - p) // s + 1 outputs, each the max of its window; the tail is dropped."""
    return _pooled(x, pool, stride, F.array_max)


def avg_pool(x, pool: int, stride: int | None = None) -> Column:
    """Same geometry, window mean."""
    return _pooled(x, pool, stride, lambda w: _sum(w) / F.lit(float(pool)))


def _per_channel(w: Column, value) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(w[0]) - 1), lambda c: value(F.transform(w, lambda v: v[c])))


def max_pool_channels(x, pool: int, stride: int | None = None) -> Column:
    """L9 over a sequence of vectors: the max per channel of each window of steps."""
    return _pooled(x, pool, stride, lambda w: _per_channel(w, F.array_max))


def avg_pool_channels(x, pool: int, stride: int | None = None) -> Column:
    """L10 over a sequence of vectors: the mean per channel of each window of steps."""
    return _pooled(x, pool, stride, lambda w: _per_channel(w, lambda v: _sum(v) / F.lit(float(pool))))


def dense_steps(x, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """L12 on every step of a sequence of vectors."""
    return F.transform(_c(x), lambda v: dense(v, weights, bias))


def dense(x, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """y[o] = sum_i x[i] * W[i][o] + b[o] (W is in x out); an input of another width fails the job."""
    a = _c(x).cast("array<double>")
    outs = len(bias)
    cols = [F.array(*[F.lit(float(weights[i][o])) for i in range(len(weights))]) for o in range(outs)]
    out = F.array(*[_sum(F.zip_with(a, cols[o], lambda u, v: u * v)) + F.lit(float(bias[o]))
                    for o in range(outs)])
    return F.when(F.size(a) == len(weights), out).otherwise(
        F.raise_error(F.lit(f"dense layer takes {len(weights)} values")))


def embedding_lookup(indices: DataFrame, index_col: str, table: DataFrame, key: str,
                     vector: str) -> DataFrame:
    """Attach the vector of each index by an equi-join on the key.

    The vector table is not force-broadcast: its size is a property of the
    model / vocabulary; Spark broadcasts it when its statistics are small.
    """
    t = table.select(F.col(key).alias(index_col), F.col(vector).alias("embedding"))
    return indices.join(t, index_col, "left")
