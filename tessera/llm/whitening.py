"""Embedding whitening by spectrum slicing.

Vectors are quantised to integers, and each distinct one is counted once (the
fit list; copies are combined before the shuffle).  Its covariance comes from
one pass: every task centres its vectors by the rounded mean, adds up integer
products, and hands over one triangle; the rounded mean's remainder is taken
out of the sums in whole numbers, so the covariance is exact before it becomes
doubles, and does not depend on how rows are dealt out.

The covariance (dimensions x dimensions, whatever the number of rows) is
decomposed on the driver.  The signs of the pivots of an LDL^T factorisation of
V - s*I count the eigenvalues below s (Sylvester's law of inertia).  Bisection
on that count cuts the spectrum into slices until one holds the wanted
eigenvalue alone, or is as narrow as rounding allows; inverse iteration in the
slice gives a start, and Rayleigh quotient iteration converges cubically.  The
quotient must lie in the slice, so the inertia counts at its ends certify the
number of the component; otherwise the slice is halved again.  Eigenvalues that
are equal to rounding share a slice; all vectors are kept orthogonal to earlier ones.

Defined results: vectors that are null, or hold a null or non-finite entry,
take no part; entries whose scaled value is not a long are an error; shorter
vectors count as padded with zeros, with fewer than ``k`` dimensions there are
fewer components; a component without variance has a null whitened value and
takes no part in identity_error (null where none has variance), explained is
null where the vectors do not vary; ties of eigenvalues are numbered as found;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import narrow, slices

LIMIT = 2.0 ** 63
DIMENSIONS = 4096         # most dimensions: the driver holds a square matrix of them


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x array<long>): floor(scale * entry) of the vectors that take part."""
    y = lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))
    long = lambda v: F.when(F.abs(v.cast("double")) * scale < LIMIT, y(v)).otherwise(
        F.raise_error(F.lit("a scaled entry is not a long")).cast("long"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                     & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.col("embedding").isNotNull() & sound).select("vec_id", F.transform("embedding", long).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dims of a list column; shorter vectors are padded with zeros."""
    sizes = pc.list_value_length(column).to_numpy()
    flat = column.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _sums(dims: int):
    """(i, s): the sums of the entries, and of the rows as i = dims."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, object)
        for batch in slices(batches, 4096):
            x = matrix(batch.column(0), dims)
            small = np.abs(x).max(initial=0) < 1 << 50
            total[:dims] += (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)
            total[dims] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int32)),
                                          pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["i", "s"])
    return run


def _products(mean: np.ndarray):
    """(i, j, s): the sums of centred entry i times centred entry j, j <= i."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        seen = False
        for batch in slices(batches, 4096):
            if batch.num_rows:
                seen = True
                x = matrix(batch.column(0), dims)
                largest = max(abs(int(x.max(initial=0)) - int(mean.min(initial=0))),
                              abs(int(x.min(initial=0)) - int(mean.max(initial=0))))
                if batch.num_rows * largest ** 2 < 1 << 53:          # doubles hold all sums exactly
                    y = (x - mean).astype(np.float64)
                    total += (y.T @ y).astype(np.int64).astype(object)
                else:
                    y = x.astype(object) - mean.astype(object)
                    total += y.T @ y
        if seen:
            i, j = np.tril_indices(dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([Decimal(int(x)) for x in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "s"])
    return run


def covariance(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(n, S, V) of the fit list ``fit`` (x): rows, sums per dimension, covariance with divisor n."""
    added = lambda df, *by: df.groupBy(*by).agg(F.sum("s").alias("s")).collect()
    total = [0] * (dims + 1)
    for r in added(fit.mapInArrow(_sums(dims), "i int, s decimal(38,0)"), "i"):      # one row per dimension
        total[r["i"]] = int(r["s"])
    n = total.pop()
    mean = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, mean)]
    products = fit.mapInArrow(_products(np.array(mean, np.int64)), "i int, j int, s decimal(38,0)")
    v = np.zeros((dims, dims))
    for r in added(products, "i", "j"):                  # a triangle of numbers
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / n ** 2    # of whole numbers, rounded once
    return n, total, v


def below(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``v`` below ``shift``: the negative pivots of LDL^T = v - shift*I,
    with symmetric pivoting by blocks of one or two rows."""
    a = v - shift * np.eye(len(v))
    alpha, negative, at, n = (1 + 17 ** 0.5) / 8, 0, 0, len(a)
    while at < n:
        s = a[at:, at:]
        diagonal = np.abs(np.diag(s))
        p = int(diagonal.argmax())
        size = len(s)
        off = np.abs(s - np.diag(np.diag(s))).max() if size > 1 else 0.0
        if size == 1 or diagonal[p] >= alpha * off:
            order = [p, *[i for i in range(size) if i != p]]
            s = s[np.ix_(order, order)]
            d = s[0, 0]
            negative += bool(d < 0)
            a = s[1:, 1:] - np.outer(s[1:, 0], s[0, 1:]) / d if d != 0 else s[1:, 1:]
        else:
            i, j = divmod(int(np.abs(s - np.diag(np.diag(s))).argmax()), size)
            order = [i, j, *[r for r in range(size) if r not in (i, j)]]
            s = s[np.ix_(order, order)]
            block = s[:2, :2]
            negative += 1 if np.linalg.det(block) < 0 else 2 * bool(block[0, 0] < 0)
            a = s[2:, 2:] - s[2:, :2] @ np.linalg.solve(block, s[:2, 2:])
        n, at = len(a), 0
    return negative


def leading(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The ``k`` largest eigenvalues of the symmetric matrix ``v`` with unit eigenvectors, falling."""
    dims = len(v)
    scale = float(np.abs(v).sum(axis=1).max(initial=0))          # no eigenvalue is larger
    least = scale * np.finfo(float).eps * 8
    start, found = np.random.default_rng(1), []
    above = lambda s: dims - below(v, s)
    for number in range(1, min(k, dims) + 1):
        lo, hi = -scale - least, scale + least                   # above(lo) >= number > above(hi)
        over_lo, over_hi = dims, 0
        while True:
            alone = over_lo - over_hi == 1
            tight = hi - lo <= least
            if alone or tight:
                value, vector = _rayleigh(v, (lo + hi) / 2, [x for _, x in found], start, scale)
                if lo - least <= value <= hi + least:            # the counts at both ends number it
                    found.append((value, vector))
                    break
                if tight:
                    raise RuntimeError("an eigenvalue was not found in its slice")
            middle = (lo + hi) / 2
            over = above(middle)
            if over >= number:
                lo, over_lo = middle, over
            else:
                hi, over_hi = middle, over
    return found


def _rayleigh(v: np.ndarray, shift: float, others: list[np.ndarray], rng, scale: float) -> tuple[float, np.ndarray]:
    """Inverse iteration at ``shift``, then Rayleigh quotient iteration, orthogonal to ``others``."""
    dims, eps = len(v), np.finfo(float).eps

    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for o in others:
                x = x - (o @ x) * o
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - shift * np.eye(dims), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (shift + 4 * eps * max(scale, 1e-300)) * np.eye(dims), x)
        return y

    x = unit(rng.standard_normal(dims))
    if scale == 0:
        return 0.0, x
    for _ in range(3):
        x = unit(solved(shift, x))
    best = None
    for _ in range(30):
        value = float(x @ v @ x)
        residual = float(np.linalg.norm(v @ x - value * x))
        if best is None or residual < best[0]:
            best = (residual, value, x)
        elif residual <= 64 * eps * scale:
            break
        x = unit(solved(value, x))
    return best[1], best[2]


def _projected(n: int, total: list[int], vectors: np.ndarray, roots: np.ndarray):
    """Functions of a matrix of x rows: n*x - S (exact) and whitened."""
    s = np.array(total, object)
    small = n < 1 << 31 and all(abs(t) < 1 << 61 for t in total)

    def apart(x: np.ndarray) -> np.ndarray:
        if small and np.abs(x).max(initial=0) < (1 << 61) // n:
            return x * n - s.astype(np.int64)
        return x.astype(object) * n - s

    def whitened(z: np.ndarray) -> np.ndarray:
        return (z.astype(np.float64) / n) @ vectors / roots
    return apart, whitened


def _squares(z: np.ndarray) -> list[int]:
    if z.dtype != object and np.abs(z).max(initial=0) < 2 ** 31.5 / max(1, z.shape[1]) ** 0.5:
        return (z * z).sum(axis=1).tolist()
    return [sum(int(c) ** 2 for c in row) for row in z]


def whiten(vectors: DataFrame, k: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error) per row
    of ``vectors`` that takes part and component up to ``k``."""
    spark, kind = vectors.sparkSession, vectors.schema["vec_id"].dataType.simpleString()
    names = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double"
    rows = narrow(quantized(vectors, scale))
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if dims > DIMENSIONS:
        raise ValueError(f"more than {DIMENSIONS} dimensions")
    if not dims:
        return spark.createDataFrame([], names + ", explained double, identity_error double")
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))
    fit = narrow(rows.select(F.concat("x", zeros).alias("x")).distinct())
    n, total, v = covariance(fit, dims)
    trace = float(np.trace(v))
    pairs = leading(v, k)
    spread = np.array([e > trace * dims * np.finfo(float).eps for e, _ in pairs])
    basis = np.stack([x for _, x in pairs], axis=1)
    roots = np.array([e ** 0.5 if ok else np.nan for (e, _), ok in zip(pairs, spread)])
    apart, whitened = _projected(n, total, basis, roots)
    used = np.flatnonzero(spread)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            w = whitened(apart(matrix(batch.column(0), dims)))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c].copy()) for c in used], [f"w{c}" for c in used])

    error = None
    if len(used):
        w = fit.mapInArrow(fitted, ", ".join(f"w{c} double" for c in used))
        entries = [F.abs(F.covar_pop(f"w{a}", f"w{b}") - float(a == b)) for a in used for b in used if a <= b]
        error = max(w.agg(*entries).first())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            z = apart(matrix(batch.column(1), dims))
            w, squares = whitened(z), _squares(z)
            dev = pa.array([Decimal(s) for s in squares], pa.decimal128(38, 0))
            for c in range(len(pairs)):
                value = pa.array(w[:, c].copy()) if spread[c] else pa.nulls(batch.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(batch.num_rows, c + 1, np.int32)),
                     pa.array(np.full(batch.num_rows, n, np.int64)), dev, value],
                    ["vec_id", "component", "n", "deviation", "whitened"])

    explained = F.lit(None).cast("double")
    for c, (e, _) in enumerate(pairs):
        if trace > 0:
            explained = F.when(F.col("component") == c + 1, F.lit(max(0.0, e) / trace)).otherwise(explained)
    return rows.select("vec_id", "x").mapInArrow(projected, names).select(
        "*", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
