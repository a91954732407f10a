import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, ids, bits=3):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least.setdefault(top(i), []).append(d)
    known = {t: min((d for d in own if d is not None), default=None) for t, own in least.items()}
    return [known[top(i)] for i in range(len(fps))]


def texts(seed=2):
    rng = random.Random(seed)
    words = [f"Word{i}" for i in range(300)]
    out = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("\n".join(copy))
    return out + ["", None, " \t", "a", "A", "a b", "ü Ü é"] * 2 + ["x y z " * 20000]


def test_against_brute_force(spark):
    t = texts()
    ids = [None if i % 17 == 0 else 1000 - i for i in range(len(t))]
    docs = spark.createDataFrame([(i, x, "a", 1) for i, x in zip(ids, t)],
                                 "doc_id long, text string, fp string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(x) for x in t]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_roots(fps, ids))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("node_rows", [4096, 24])
def test_links_connect_all_near_fingerprints(spark, node_rows):
    """A dense cluster and chains; with 24 rows to a node most nodes are divided, some twice."""
    rng = random.Random(7)
    fps = {0, 2 ** 64 - 1}
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        fps |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
    for _ in range(30):                                    # chains of 3-bit steps
        x = rng.getrandbits(64)
        for _ in range(6):
            x ^= sum(1 << b for b in rng.sample(range(64), 3))
            fps.add(x)
    fps = sorted(fps)
    signed = lambda f: f - (1 << 64) if f >= 1 << 63 else f
    nodes = spark.createDataFrame([(signed(f), i) for i, f in enumerate(fps)], "fp long, doc_id long")
    roots = simhash.components(simhash.links(nodes, 3, node_rows))
    member = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("doc_id", F.coalesce("root", "fp").alias("r"))
    got = {}
    for r in member.collect():
        got.setdefault(r.r, []).append(r.doc_id)
    want = {}
    for i, c in enumerate(brute_roots(fps, list(range(len(fps))))):
        want.setdefault(c, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_pruning_loses_no_pair():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 2 ** 63, 500, dtype=np.uint64) & np.uint64(0x0F0F00FF))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    got = {(a, b) for x, y in simhash.linked_pairs(fps, 3) for a, b in zip(x.tolist(), y.tolist())}
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(close, 1)))}


def test_gray_rank_is_the_inverse_gray_code():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()
