"""MinHash near-duplicates by chosen-path set similarity join.

A document's set holds its distinct shingles; sets that are equal are one node
from here on, so groups of copies cost one row.  ``WIDTH`` minwise hashes embed
each set: two sets of Jaccard similarity J agree in about J of the places, and
a place with its minimum is a token of the set.

Chosen paths: a tree starts with all nodes at its root.  At every tree node a
hash of (path so far, token) selects tokens, each with probability
``branch / (threshold * WIDTH)``, and a document goes to the child of every
selected token it holds.  A document's path depends on nothing but its own
tokens and the seeds, so one level of all trees is a projection, and a child is
a group of rows with one key.  Two sets at the threshold share ``branch``
children per tree node on average, dissimilar ones far fewer.  A tree node with
at most ``leaf`` members is compared exhaustively; larger ones are branched
again, until a level no longer halves the members of large nodes.  The number of
independent trees follows from ``recall``: a pair at the threshold is lost by one
tree, however deep, with at most the extinction probability of its branching process.

Comparing means counting agreeing places; pairs that agree in fewer than five
standard deviations below the threshold's mean are left out (one pair in some
millions at the threshold), and all others are confirmed on the full sets of
shingles.  Only connectivity is wanted, so the first round tests each member
against its nearest predecessor of a small tree node, and the members of a
large one against its pivot; the second round tests every remaining pair of
similar members of a small node that the first did not connect.  Nodes that are
still large at the last level hold sets too similar to be branched apart; those
that share members are one group, searched in cells of members outside its main
component x all members.  A cell has the texts of its members, tests pairs of
different components on the full sets, the most similar first, and forgets the
others of a component once it is reached, so it returns a forest of links.

Defined results: null and empty texts have an empty set and are linked with
nothing (also not with each other); a text with fewer words than a shingle is
one shingle, the whole sequence; null doc_ids are ignored for component ids
unless a component has no other (then null, and kept); repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, materialize, narrow, text_bytes
from tessera.llm.simhash import components

WIDTH = 128               # minwise hashes of a set
LEAF = 256                # members of a tree node that is compared exhaustively
BRANCH = 1.5              # children that two sets at the threshold share, on average
RECALL = 0.9995           # of pairs at the threshold, at any depth
FILTER = 1 << 21          # most hashes that are broadcast to pick texts before the shuffle
CELL = 1024               # members on a side of a cell
PAIRS = 256               # pairs of one document confirmed by one task
SLICE = 2048              # shingles that are hashed into a signature at once
FLUSH = 1 << 14           # rows that are compared at once

_RANDOM = np.random.default_rng(20240229)
_FACTOR = _RANDOM.integers(0, 1 << 63, WIDTH, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, WIDTH, dtype=np.uint64)


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """The 64-bit hashes of the distinct shingles of a UTF-8 text, sorted."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    n = len(words) - size + 1
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[size - 1:] - 1).tolist()
    return np.unique(np.fromiter((xxh64_intdigest(flat[a:b], 7) for a, b in zip(starts, stops)), np.uint64, n))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low 32 bits of ``WIDTH`` minwise hashes."""
    least = np.full(WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        least = np.minimum(least, (hashes[None, at:at + SLICE] * _FACTOR[:, None] + _SHIFT[:, None]).min(axis=1))
    return least.astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def survival(branch: float, depth: int = 1000) -> float:
    """Probability that a pair that shares ``branch`` children on average shares a node at ``depth``."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-branch * alive)
    return alive


def trees_for(recall: float, branch: float = BRANCH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(branch)))


def least_agreement(threshold: float) -> int:
    """Agreeing places below which a pair is not confirmed."""
    return math.floor(WIDTH * threshold - 5 * math.sqrt(WIDTH * threshold * (1 - threshold)))


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in batches:
            sizes, keys, sigs, bytes8 = [], [], [], []
            for text in batch.column(3):
                s = shingle_set(text.as_py(), shingle)
                sizes.append(len(s))
                keys.append(xxh3_128_digest(s.tobytes()))
                sig = signature(s)
                sigs.append(sig.tobytes())
                bytes8.append(sig.astype(np.uint8).tobytes())
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(sigs, pa.binary()),
                 pa.array(bytes8, pa.binary())],
                ["doc_id", "t1", "t2", "n_shingles", "h1", "h2", "sig", "sig8"])
    return run


def _children(probability: float, trees: int):
    """(key, id) of the children of each row's tree node; without a node, of all roots."""
    limit = np.uint64(min(2 ** 64 - 1, int(probability * 2 ** 64)))
    place = np.arange(WIDTH, dtype=np.uint64) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, WIDTH)
            tokens = _mix(sig.astype(np.uint64) | place)
            if batch.num_columns > 2:
                starts = [batch.column(2).to_numpy().view(np.uint64)]
            else:
                starts = [np.full(len(ids), _mix(np.uint64([t + 1]))[0]) for t in range(trees)]
            for start in starts:
                drawn = _mix(tokens ^ start[:, None])
                row, col = np.nonzero(drawn < limit)
                yield pa.RecordBatch.from_arrays([pa.array(_mix(drawn[row, col]).view(np.int64)), pa.array(ids[row])],
                                                 ["key", "id"])
    return run


def _similar_pairs(key: np.ndarray, sig: np.ndarray, size: np.ndarray, least: int, threshold: float
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, agreeing places) of rows j < i with one key that may reach the threshold."""
    out = []
    for k in range(1, LEAF):
        same = np.flatnonzero(key[k:] == key[:-k]) if len(key) > k else []
        if not len(same):
            break
        small, large = np.minimum(size[same], size[same + k]), np.maximum(size[same], size[same + k])
        same = same[small >= threshold * large - 1e-9]
        for at in range(0, len(same), FLUSH):
            part = same[at:at + FLUSH]
            agree = (sig[part] == sig[part + k]).sum(axis=1)
            hit = agree >= least
            out.append((part[hit] + k, part[hit], agree[hit]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _compare(least: int, threshold: float, everything: bool):
    """Pairs (u, v) to confirm, of rows that come sorted by key: each row with its nearest
    predecessor, or all pairs of different components."""
    def pairs(key, ids, size, comp, sig):
        i, j, agree = _similar_pairs(key, sig, size, least, threshold)
        if everything:
            differ = comp[i] != comp[j]
            i, j = i[differ], j[differ]
        else:
            order = np.lexsort((j, -agree, i))
            first = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
            i, j = i[first], j[first]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))],
                                          ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in range(4)]
            now.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, WIDTH))
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if len(held[0]) >= FLUSH:
                whole = np.flatnonzero(np.diff(held[0]))          # the last key may go on
                if len(whole):
                    cut = whole[-1] + 1
                    yield pairs(*[x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held is not None:
            yield pairs(*held)
    return run


def _agreeing(least: int):
    """The pairs (u, v, sig of u, sig of v) that may reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, WIDTH) for c in (2, 3))
                near = (a == b).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in (0, 1)], ["u", "v"])
    return run


def _cell(least: int, percent: int, shingle: int):
    """Confirmed links between components, of members outside the main one and all members."""
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        us, vs = [], []
        if len(left) and len(right):
            sig = np.frombuffer(b"".join(right["sig8"]), np.uint8).reshape(-1, WIDTH)
            ids, size = right["id"].to_numpy(), right["n_shingles"].to_numpy()
            names, comp = np.unique(np.concatenate((left["comp"], right["comp"])), return_inverse=True)
            own, root = comp[:len(left)], np.arange(len(names))
            sets: dict[int, np.ndarray] = {}

            def full(j: int) -> np.ndarray:
                if j not in sets:
                    sets[j] = shingle_set(right["text"].iat[j], shingle)
                return sets[j]

            for i, c, n, s, text in zip(left["id"], own, left["n_shingles"], left["sig8"], left["text"]):
                near = np.flatnonzero(100 * np.minimum(size, n) >= percent * np.maximum(size, n))
                agree = (sig[near] == np.frombuffer(s, np.uint8)).sum(axis=1)
                near = near[np.lexsort((near, -agree))][:int((agree >= least).sum())]
                near = near[root[comp[len(left) + near]] != root[c]]
                mine = shingle_set(text, shingle) if len(near) else None
                while len(near):
                    some, near = near[:32], near[32:]
                    parts = [full(j) for j in some.tolist()]
                    flat = np.concatenate(parts)
                    at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                    starts = np.cumsum([0, *map(len, parts[:-1])])
                    shared = np.add.reduceat((mine[at] == flat).astype(np.int64), starts)
                    hits = some[100 * shared >= percent * (n + size[some] - shared)]
                    for j in hits.tolist():
                        a, b = root[c], root[comp[len(left) + j]]
                        if a != b:
                            us.append(min(i, ids[j]))
                            vs.append(max(i, ids[j]))
                            root[root == max(a, b)] = min(a, b)
                    if len(hits):
                        near = near[root[comp[len(left) + near]] != root[c]]
        return pd.DataFrame({"u": np.array(us, np.int64), "v": np.array(vs, np.int64)})
    return search


def _confirm(percent: int, shingle: int):
    """Pairs whose full sets reach the threshold; a group's first row has the text of ``u``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for batch in batches:
            us, vs = [], []
            for u, salt, v, text in zip(*[batch.column(c) for c in range(4)]):
                u, salt, v = u.as_py(), salt.as_py(), v.as_py()
                hashes = shingle_set(text.as_py(), shingle)
                if v is None:
                    group, own = (u, salt), hashes
                    continue
                if group != (u, salt):
                    raise RuntimeError("a pair came without the text of its first document")
                shared = len(np.intersect1d(own, hashes, assume_unique=True))
                if 100 * shared >= percent * (len(own) + len(hashes) - shared):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
    return run


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2"),
                       text_bytes(F.col("text")).alias("text"))


def document_sets(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, t1, t2, n_shingles, h1, h2, sig, sig8): hashes of the text and of its set, the
    signature, and its low bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _hashed(docs).mapInArrow(_sets(shingle), f"doc_id {kind}, t1 long, t2 long, n_shingles long, "
                                                    "h1 long, h2 long, sig binary, sig8 binary")


def tree_nodes(nodes: DataFrame, trees: int, probability: float, leaf: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (key, id) of the small tree nodes of all levels, pairs (u, v) of the members of
    large ones with their pivot, and those pairs of the nodes that are large at the last level."""
    small, stars, todo, before = [], [], nodes.select("id", "sig"), None
    while True:
        # what comes from a shuffle or from few large files is written as it lies, not dealt once more
        keys = materialize(todo.mapInArrow(_children(probability, trees), "key long, id long"))
        sizes = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot"))
                       .where(F.col("n") > 1).withColumnRenamed("key", "_k"))
        placed = keys.join(sizes, F.col("key") == F.col("_k"))
        small.append(placed.where(F.col("n") <= leaf).select("key", "id"))
        large = narrow(placed.where(F.col("n") > leaf).select("key", "id", "pivot"))
        stars.append(large.where(F.col("id") != F.col("pivot")).select(F.col("pivot").alias("u"), F.col("id").alias("v")))
        now = large.count()
        if not now or before is not None and now > before / 2:
            break
        before = now
        sig = nodes.select(F.col("id").alias("_i"), "sig")
        todo = large.join(sig, F.col("id") == F.col("_i")).select("id", "sig", "key")
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return materialize(union(small)), union(stars).distinct(), stars[-1].distinct()


def texts_of(ids: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, text) of the node ids in ``ids``, written to the shared folder."""
    named = nodes.select(F.col("id").alias("_i"), F.col("doc_id").alias("_d"), F.col("t1").alias("_1"), F.col("t2").alias("_2"))
    wanted = narrow(ids.join(named, F.col("id") == F.col("_i")).select("id", "_d", "_1", "_2"))
    hashed = _hashed(docs)
    if wanted.count() <= FILTER:                         # beyond it all texts are shuffled, to the same result
        hashed = hashed.join(F.broadcast(wanted.select(F.col("_1").alias("_b"))), F.col("t1") == F.col("_b"), "left_semi")
    return materialize(hashed.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t1") == F.col("_1"))
                                          & (F.col("t2") == F.col("_2"))).select("id", "text").dropDuplicates(["id"]))


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (u, v) of node ids whose full sets reach the threshold."""
    texts = texts_of(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct(), nodes, docs)
    salts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAIRS)).alias("salts")).withColumnRenamed("u", "_u")
    first = (salts.join(texts, F.col("_u") == F.col("id"))
             .select(F.col("_u").alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                     F.lit(None).cast("long").alias("v"), "text"))
    others = (pairs.join(salts, F.col("u") == F.col("_u")).join(texts, F.col("v") == F.col("id"))
              .select("u", F.pmod(F.xxhash64("v"), F.col("salts")).alias("salt"), "v", "text"))
    with arrow_batches(docs.sparkSession):
        return narrow(first.unionByName(others).repartition("u", "salt").sortWithinPartitions("u", "salt", "v")
                      .mapInArrow(_confirm(percent, shingle), "u long, v long"))


def dense_links(groups: DataFrame, own: DataFrame, nodes: DataFrame, docs: DataFrame, least: int, percent: int,
                shingle: int) -> DataFrame:
    """Links (u, v) between components within ``groups`` (node, root) of members of dense tree nodes."""
    rows = (groups.join(own, F.col("node") == F.col("id"))
            .select(F.col("root").alias("key"), "id", "comp", "n_shingles", "sig8"))
    shares = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = narrow(shares.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("m"),
                                            F.max("n").alias("n")).where(F.col("n") < F.col("m"))
                  .select(F.col("key").alias("_k"), "main", F.ceil((F.col("m") - F.col("n")) / CELL).alias("lb"),
                          F.ceil(F.col("m") / CELL).alias("rb")))
    rows = rows.join(main, F.col("key") == F.col("_k"))
    texts = texts_of(rows.select("id"), nodes, docs).withColumnRenamed("id", "_i")
    rows = rows.join(texts, F.col("id") == F.col("_i"))
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).alias(n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(n)
    columns = ["key", "id", "comp", "n_shingles", "sig8", "text"]
    left = rows.where(F.col("comp") != F.col("main")).select(*columns, block("lb", 1), every("rb"))
    right = rows.select(*[F.col(c).alias(c) for c in columns], every("lb"), block("rb", 2))
    return narrow(left.groupBy("key", "lb", "rb").cogroup(right.groupBy("key", "lb", "rb"))
                  .applyInPandas(_cell(least, percent, shingle), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 85, recall: float = RECALL,
                    branch: float = BRANCH, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text): documents are
    linked when 100 * intersection >= ``percent`` * union of their sets."""
    if not 0 < leaf <= LEAF:
        raise ValueError(f"a small tree node has at most {LEAF} members")
    threshold, trees = percent / 100, trees_for(recall, branch)
    probability, least = branch / (threshold * WIDTH), least_agreement(threshold)
    with arrow_batches(docs.sparkSession):
        rows = materialize(document_sets(docs, shingle))
    nodes = materialize(rows.where(F.col("n_shingles") > 0).groupBy("h1", "h2")
                   .agg(F.first(F.struct("doc_id", "t1", "t2", "n_shingles", "sig", "sig8")).alias("x"),
                        F.min("doc_id").alias("least_id"))
                   .select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "least_id", "x.*"))
    member = nodes.select("id", "n_shingles", "sig8")
    small, stars, dense = tree_nodes(nodes, trees, probability, leaf)

    def compared(comps: DataFrame | None) -> DataFrame:
        own = with_components(member, comps).withColumnRenamed("id", "_i")
        placed = small.join(own, F.col("id") == F.col("_i"))
        if comps is not None:                                  # tree nodes of one component are done
            mixed = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                     .where(F.col("lo") < F.col("hi")).select(F.col("key").alias("_k")))
            placed = placed.join(mixed, F.col("key") == F.col("_k"), "left_semi")
        return (placed.select("key", "id", "n_shingles", "comp", "sig8").repartition("key")
                .sortWithinPartitions("key", "id")
                .mapInArrow(_compare(least, threshold, comps is not None), "u long, v long"))

    sig = member.select(F.col("id").alias("_i"), "sig8")
    near = (stars.join(sig, F.col("u") == F.col("_i")).select("u", "v", F.col("sig8").alias("su"))
            .join(sig, F.col("v") == F.col("_i")).select("u", "v", "su", F.col("sig8").alias("sv"))
            .mapInArrow(_agreeing(least), "u long, v long"))
    tested = narrow(compared(None).unionByName(near).distinct())
    links = confirmed(tested, nodes, docs, percent, shingle)
    # one run for two graphs: links on even numbers, members of dense tree nodes on odd ones
    both = links.select((F.col("u") * 2).alias("u"), (F.col("v") * 2).alias("v")).unionByName(
        dense.select((F.col("u") * 2 + 1).alias("u"), (F.col("v") * 2 + 1).alias("v")))
    found = components(both)
    graph = lambda odd: found.where(F.col("node") % 2 == odd).select(
        F.shiftright("node", 1).alias("node"), F.shiftright("root", 1).alias("root"))
    comps, groups = graph(0), graph(1)
    rest = compared(comps)
    rest = narrow(rest.distinct().join(tested.select(F.col("u").alias("_u"), F.col("v").alias("_v")),
                                       (F.col("u") == F.col("_u")) & (F.col("v") == F.col("_v")), "left_anti"))
    more = [] if rest.isEmpty() else [confirmed(rest, nodes, docs, percent, shingle)]
    if not groups.isEmpty():
        more.append(dense_links(groups, with_components(member, comps), nodes, docs, least, percent, shingle))
    more = [m for m in more if not m.isEmpty()]
    if more:
        for m in more:
            links = links.unionByName(m)
        comps = components(links)

    rooted = nodes.join(comps, F.col("id") == F.col("node"), "left").select(
        "h1", "h2", "least_id", F.coalesce("root", "id").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumnRenamed("root", "_r")
    named = rooted.join(smallest, F.col("root") == F.col("_r")).select(
        F.col("h1").alias("_1"), F.col("h2").alias("_2"), "component_id", F.lit(True).alias("linked"))
    out = rows.join(named, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def with_components(member: DataFrame, comps: DataFrame | None) -> DataFrame:
    """``member`` with ``comp``, the root of the component, without components the id itself."""
    if comps is None:
        return member.withColumn("comp", F.col("id"))
    return member.join(comps, F.col("id") == F.col("node"), "left").select(
        "id", "n_shingles", "sig8", F.coalesce("root", "id").alias("comp"))
