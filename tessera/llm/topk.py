"""Exact top-k search by inner product: columnar branch and bound.

Candidates and queries are cut into blocks and every pair of blocks is one
cell of a grid, so memory is bounded by the block sizes; a cell's candidates
lie in vertical layout (one row per dimension).  For each query the scores
are accumulated one block of dimensions at a time.  After each block the
Cauchy-Schwarz product of the remaining masses (the norms of the dimensions
not yet seen) bounds every candidate from above and below; candidates whose
upper bound lies under the k-th best lower bound are dropped and the
survivors are compacted.  Ties survive: a candidate goes only if its upper
bound is strictly smaller.  Cells return at most k rows per query, and the
best k of those are taken per query.

Vectors whose products need not fit a long in their cell are multiplied exactly
in three limbs, without pruning; those with a scaled component beyond a long, as
Python integers.

Defined results: vectors that are null, or hold a null or non-finite
component, take no part; all others do, however large; a score among the
results that does not fit a long is an error; shorter vectors count as padded with
zeros; rows that share the query's id are its own; repeated query rows each
get a list of their own; a null id can be found (after all other ids) but is
never a query; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import narrow

DIM_BLOCK = 16            # dimensions accumulated between two prunings
CANDIDATES = 16384        # candidates in a cell
QUERIES = 1024            # queries in a cell
LIMIT = 2.0 ** 63
LIMB = 22                 # bits of the limbs of a component
LEAST, MOST = -(1 << 63), (1 << 63) - 1          # stand for scores beyond a long


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, x array<long>, far array<double>): floor(scale * component) of the vectors that
    take part; where one of them is not a long, x has zeros and ``far`` the components themselves."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    fits = F.forall(v, lambda c: F.abs(c) * scale < LIMIT)
    x = F.transform(v, lambda c: F.when(F.abs(c) * scale < LIMIT, F.floor(F.lit(scale) * c)).otherwise(F.lit(0)).cast("long"))
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.where(F.col("embedding").isNotNull() & sound)
            .select("vec_id", x.alias("x"), F.when(~fits, v).alias("far")))


def _integers(far: pd.Series, dims: int, scale: int) -> dict[int, np.ndarray]:
    """Position and exact scaled components of the vectors that have ``far``."""
    out = {}
    for i, v in enumerate(far):
        if v is not None:
            out[i] = np.zeros(dims, object)
            out[i][:len(v)] = [int(c) * scale if abs(c) >= LIMIT / scale else floor(c * scale) for c in map(float, v)]
    return out


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    """Vertical layout: dims x n."""
    out = np.zeros((dims, len(rows)), np.int64)
    for i, x in enumerate(rows):
        out[:len(x), i] = x
    return out


def search_block(queries: np.ndarray, cands: np.ndarray, own: list[np.ndarray], ids: np.ndarray, k: int):
    """Per query the positions and scores of its k best candidates, by (score desc, id)."""
    dims = len(cands)
    cuts = list(range(0, dims, DIM_BLOCK)) or [0]

    def masses(m: np.ndarray) -> list[np.ndarray]:      # norm of the dimensions from each cut on
        squares = np.vstack([np.zeros((1, m.shape[1])), np.cumsum((m[::-1].astype(np.float64)) ** 2, axis=0)])
        return [np.sqrt(squares[dims - c]) for c in [*cuts, dims]]

    rest_c, rest_q = masses(cands), masses(queries)
    for q in range(queries.shape[1]):
        alive = np.arange(cands.shape[1])
        if len(own[q]):
            alive = np.setdiff1d(alive, own[q], assume_unique=True)
        score = np.zeros(len(alive), np.int64)
        for b, c in enumerate(cuts):
            block = slice(c, min(c + DIM_BLOCK, dims))
            part = cands[block] if len(alive) == cands.shape[1] else cands[block][:, alive]
            score = score + queries[block, q] @ part
            if b + 1 < len(cuts) and len(alive) > k:
                slack = rest_q[b + 1][q] * rest_c[b + 1][alive] * (1 + 1e-9) + 1 + np.abs(score) * 1e-15
                least = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                stays = score + slack >= least
                alive, score = alive[stays], score[stays]
        if len(alive) > k:                              # all that tie with the k-th, then by id
            stays = score >= np.partition(score, len(alive) - k)[len(alive) - k]
            alive, score = alive[stays], score[stays]
        order = np.lexsort((ids[alive], -score))[:k]
        yield alive[order], score[order]


def _limbs(m: np.ndarray) -> list[np.ndarray]:
    """m = sum of limb i * 2^(i * LIMB); the last limb has the sign."""
    low = (1 << LIMB) - 1
    return [m & low, (m >> LIMB) & low, m >> 2 * LIMB]


def _exact(query: list[np.ndarray], cands: list[np.ndarray]) -> np.ndarray:
    """Scores as Python integers, from the limbs of a query and of candidates."""
    out = np.zeros(cands[0].shape[1], object)
    for i, a in enumerate(query):
        for j, b in enumerate(cands):
            out += (a @ b).astype(object) << (i + j) * LIMB
    return out


def search_cell(queries: np.ndarray, cands: np.ndarray, own: list[np.ndarray], ids: np.ndarray, k: int,
                far_queries: dict[int, np.ndarray] | None = None, far_cands: dict[int, np.ndarray] | None = None
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``search_block`` for components of any size: pairs of vectors whose products need not
    fit a long are multiplied exactly.  ``far_...`` are vectors (by position) that do not fit
    the matrices.  Scores beyond a long are LEAST or MOST."""
    far_queries, far_cands = far_queries or {}, far_cands or {}
    fits = isqrt((1 << 62) // max(1, len(cands)))
    largest = np.abs(cands).max(axis=0, initial=0)
    far = np.array(sorted(far_cands), np.int64)
    largest[far] = MOST
    small, wide = np.flatnonzero(largest <= fits), np.flatnonzero(largest > fits)
    plain = np.abs(queries).max(axis=0, initial=0) <= fits
    plain[list(far_queries)] = False
    if not len(wide) and plain.all():
        yield from search_block(queries, cands, own, ids, k)
        return
    place = np.full(cands.shape[1], -1)
    place[small] = np.arange(len(small))
    kept = [p[p >= 0] for p in (place[own[q]] for q in np.flatnonzero(plain))]
    fast = search_block(queries[:, plain], cands[:, small], kept, ids[small], k)
    limbs = _limbs(cands[:, wide] if plain.all() else cands)
    beyond = np.column_stack([far_cands[c] for c in far.tolist()]) if len(far) else None
    for q in range(queries.shape[1]):
        slow = wide if plain[q] else np.arange(cands.shape[1])
        if q in far_queries:
            score = far_queries[q] @ cands.astype(object)
        else:
            score = _exact(_limbs(queries[:, q]), [x[:, wide] for x in limbs] if plain[q] and not plain.all() else limbs)
        if len(far):
            score[np.searchsorted(slow, far)] = far_queries.get(q, queries[:, q].astype(object)) @ beyond
        alive = ~np.isin(slow, own[q])
        at, score = slow[alive], score[alive]
        if plain[q]:
            near, of = next(fast)
            at, score = np.append(small[near], at), np.append(of.astype(object), score)
        best = sorted(range(len(at)), key=lambda i: (-score[i], ids[at[i]]))[:k]  # noqa: B023
        yield at[best], np.array([min(max(int(score[i]), LEAST), MOST) for i in best], np.int64)


def _cell(k: int, scale: int):
    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "query_id": [], "vec_id": [], "score": []})
        dims = max(left["x"].map(len).max(), right["x"].map(len).max())
        none = right["vec_id"].isna().to_numpy()
        real = right["vec_id"].astype("Int64").fillna(0).to_numpy(np.int64)
        ids = np.where(none, np.iinfo(np.int64).max, real)
        order = np.argsort(ids, kind="stable")
        sorted_ids = ids[order]
        qids = left["vec_id"].to_numpy(np.int64)
        lo, hi = np.searchsorted(sorted_ids, qids, "left"), np.searchsorted(sorted_ids, qids, "right")
        own = [order[a:b][~none[order[a:b]]] for a, b in zip(lo, hi)]
        out = []
        found = search_cell(_matrix(left["x"], dims), _matrix(right["x"], dims), own, ids, k,
                            _integers(left["far"], dims, scale), _integers(right["far"], dims, scale))
        for q, qid, (at, score) in zip(left["q"], qids, found):
            out.append(pd.DataFrame({"q": q, "query_id": qid, "vec_id": pd.array(real[at], "Int64"), "score": score}))
            out[-1].loc[none[at], "vec_id"] = pd.NA
        return pd.concat(out)
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each query row."""
    rows = narrow(quantized(vectors, scale).withColumn("q", F.monotonically_increasing_id()))
    queries = rows.where(F.col("vec_id").isNotNull() & is_query)
    sizes = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id").isNotNull() & is_query)).first()
    c_blocks, q_blocks = max(1, -(-sizes[0] // CANDIDATES)), max(1, -(-sizes[1] // QUERIES))
    deal = lambda n, salt: F.pmod(F.xxhash64("q", F.lit(salt)), F.lit(n))
    left = queries.withColumn("qb", deal(q_blocks, 1)) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    right = rows.withColumn("cb", deal(c_blocks, 2)).drop("q") \
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    found = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
             .applyInPandas(_cell(k, scale), "q long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    whole = F.when(F.col("score").isin(LEAST, MOST), F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", whole.otherwise(F.col("score")).alias("score")))
