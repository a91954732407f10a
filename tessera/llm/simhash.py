"""SimHash near-duplicate detection with a Gray-order hierarchical index.

Fingerprints: a text's words, A-Z lower-cased, give shingles of
``shingle`` words (repeats count); a bit is 1 when it is set in over half of
the shingles' 64-bit hashes.  Equal fingerprints are one node from here on,
with the smallest doc_id of its rows, so groups of copies cost one row.

Index: upper nodes factor out shared masked bit patterns.  Two fingerprints
that differ in at most ``max_bits`` bits agree in at least one of
``max_bits + 1`` disjoint masks, so each fingerprint is filed under one node
per mask, keyed by its bits there.  A node with more than ``node_rows``
fingerprints is divided again: the bits it has not fixed are cut into
``max_bits + 1`` masks, and its fingerprints move to the children; as every
level fixes more bits, nodes end bounded whatever the data (all but r bits
fixed leave at most 2^r distinct fingerprints).  Below an upper node the
fingerprints are sorted by Gray rank, which puts those with few differing
high bits side by side; runs of them form inner nodes that keep the bits
their members share, and a pair of inner nodes is pruned as a whole when
their shared bits already differ in more than ``max_bits`` places.  Only
surviving pairs of nodes are compared member by member.

A node emits a spanning forest of its links (each linked fingerprint and its
local root), never all pairs.  Connected components follow by large-star /
small-star contraction on those edges, in the shared folder, round by round.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; texts with fewer words than a shingle hash the whole
sequence; null doc_ids are ignored for component ids unless a component has
no other (then null); repeated rows get equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, narrow, text_bytes

NODE_ROWS = 4096          # fingerprints under one upper node
LEAF = 32                 # fingerprints under one inner node
SLICE = 1 << 16           # shingles hashed at once


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[size - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        hashes = np.array([xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[at:at + SLICE], stops[at:at + SLICE])],
                          dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes(F.col("text")).alias("t")).mapInArrow(
        _fingerprints(shingle), f"doc_id {kind}, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in Gray order (the inverse Gray code)."""
    rank = fp.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def linked_pairs(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of ``fps`` (in Gray order) within ``max_bits`` bits, in bounded slices."""
    n = len(fps)
    cuts = np.arange(0, n, LEAF)
    ones, some = np.bitwise_and.reduceat(fps, cuts), np.bitwise_or.reduceat(fps, cuts)
    for i in range(len(cuts)):
        # differences that all members of the two nodes have in common
        apart = (ones[i] & ~some[i:]) | (ones[i:] & ~some[i])
        near = np.flatnonzero(np.bitwise_count(apart) <= max_bits) + i
        own = np.arange(cuts[i], min(cuts[i] + LEAF, n))
        other = (cuts[near][:, None] + np.arange(LEAF)).ravel()
        other = other[other < n]
        close = np.bitwise_count(fps[own][:, None] ^ fps[other][None, :]) <= max_bits
        a, b = np.nonzero(close)
        a, b = own[a], other[b]
        yield a[a < b], b[a < b]


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (child, root) of the components under one upper node; no edge for a single."""
    order = np.argsort(gray_rank(fps), kind="stable")
    fps = fps[order]
    root = np.arange(len(fps))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked_pairs(fps, max_bits):
        for x, y in zip(a.tolist(), b.tolist()) if len(a) < 64 else _reduced(root, a, b):
            x, y = top(x), top(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    tops = np.array([top(x) for x in range(len(fps))], dtype=np.int64)
    child = np.flatnonzero(tops != np.arange(len(fps)))
    return fps[child], fps[tops[child]]


def _reduced(root: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Pairs whose ends do not already point to the same place."""
    while True:                                       # flatten, so that most pairs show as joined
        flat = root[root]
        if (flat == root).all():
            break
        root[:] = flat
    differ = root[a] != root[b]
    pairs = np.unique(np.stack([root[a[differ]], root[b[differ]]]), axis=1)
    return zip(pairs[0].tolist(), pairs[1].tolist())


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by node; a node's rows may cross batches."""
        key, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            sizes = np.diff(bounds)
            us, vs = [], []
            # small nodes all at once: rows that lie k apart in the same node
            small = np.repeat(sizes <= LEAF, sizes)
            for k in range(1, LEAF):
                same = np.flatnonzero(small[:-k] & (key[k:] == key[:-k])) if len(key) > k else []
                if not len(same):
                    break
                hit = same[np.bitwise_count(fps[same] ^ fps[same + k]) <= max_bits]
                us.append(fps[hit])
                vs.append(fps[hit + k])
            for i in np.flatnonzero(sizes > LEAF):
                u, v = forest(fps[bounds[i]:bounds[i + 1]], max_bits)
                us.append(u)
                vs.append(v)
            u, v = (np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64) for x in (us, vs))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            key = np.concatenate((key, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy().view(np.uint64)))
            whole = len(key) - int((key == key[-1])[::-1].argmin()) if len(key) and key[0] != key[-1] else 0
            if whole:
                yield edges(key[:whole], fps[:whole])
                key, fps = key[whole:], fps[whole:]
        if len(key):
            yield edges(key, fps)
    return run


def _masks(free: list[int], parts: int) -> list[list[int]]:
    """``free`` bit numbers cut into ``parts`` runs of about equal length."""
    cuts = [round(i * len(free) / parts) for i in range(parts + 1)]
    return [free[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask_value(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def links(nodes: DataFrame, max_bits: int = 3, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges (u, v) that connect all of the distinct ``fp`` within ``max_bits`` bits.

    Level by level, upper nodes that hold too many rows hand them to children
    with more bits fixed; all others are searched.
    """
    parts, found = max_bits + 1, None
    # nodes of a level: which bits are fixed (by path of mask numbers) is the same for all rows of a path
    paths, todo = {"": list(range(63, -1, -1))}, nodes.select("fp", F.lit("").alias("path"))
    while True:
        fixed = {p: [b for b in range(64) if b not in free] for p, free in paths.items()}
        step = F.create_map(*[x for p, free in paths.items() for x in (
            F.lit(p), F.array(*[F.struct(F.lit(p + str(i)).alias("path"),
                                         F.lit(_mask_value(fixed[p] + m)).alias("mask"))
                                for i, m in enumerate(_masks(free, parts))]))])
        filed = (todo.select("fp", F.explode(step[F.col("path")]).alias("m"))
                 .select("fp", "m.path", F.xxhash64("m.path", F.col("fp").bitwiseAND(F.col("m.mask"))).alias("node")))
        paths = {p + str(i): [b for b in free if b not in m] for p, free in paths.items()
                 for i, m in enumerate(_masks(free, parts))}
        counted = filed.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        large = narrow(counted.where(F.col("n") > node_rows).select(F.col("node").alias("_n")))
        divisible = min(len(free) for free in paths.values()) > max_bits + 11
        n_large = large.count() if divisible else 0
        small = filed.join(large, F.col("node") == F.col("_n"), "left_anti") if n_large else filed
        at_level = (small.select("node", "fp").repartition("node").sortWithinPartitions("node", "fp")
                    .mapInArrow(_links(max_bits), "u long, v long"))
        found = at_level if found is None else found.unionByName(at_level)
        if not n_large:
            return found.distinct()
        todo = narrow(filed.join(large, F.col("node") == F.col("_n"), "left_semi")
                           .select("fp", "path").distinct())
        keep = {r["path"] for r in todo.select("path").distinct().collect()}      # at most parts ** depth strings
        paths = {p: free for p, free in paths.items() if p in keep}


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every end of an edge (u, v): root is the smallest node it is connected to."""
    stars = narrow(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        # large star: neighbours above a node go to the smallest of its neighbourhood
        large = (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("_u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: the others, and the node itself, go to its smallest neighbour below
        large = narrow(large.where(F.col("u") != F.col("v")))
        below = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = (large.join(below, F.col("u") == F.col("_u"))
                 .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct("u", F.col("m").alias("v")))))
                 .where(F.col("u") != F.col("v")).distinct())
        stars = narrow(small)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text)."""
    with arrow_batches(docs.sparkSession):
        rows = narrow(fingerprints(docs, shingle))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = components(links(nodes, max_bits, node_rows))
    member = nodes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "_r")
    named = member.join(smallest, F.col("root") == F.col("_r")).select(F.col("fp").alias("_f"), "component_id")
    return rows.join(named, F.col("fp") == F.col("_f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
