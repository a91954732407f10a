import random
import re

import numpy as np
import pytest

from tessera.llm import minhash
from tessera.llm.common import narrow
from pyspark.sql import functions as F


def brute_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows, by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = top(i), top(j)
                    root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    known = {t: min((d for d in own if d is not None), default=None) for t, own in least.items()}
    return [(d, len(s), known[top(i)] if s else d, d == (known[top(i)] if s else d))
            for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed=5, groups=40):
    """Groups of near copies on both sides of the threshold, chains, copies, subsets."""
    rng = random.Random(seed)
    words = [f"Word{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        out.append(" ".join(text))
        for _ in range(rng.randint(0, 7)):
            if rng.random() < 0.5:
                text = list(text)                            # a chain, else all from one original
            near = text if rng.random() < 0.3 else list(text)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = rng.choice(words)
            out.append(rng.choice(["\n", " ", "\t "]).join(near))
        out.append(" ".join(text + [rng.choice(words)]))
    rng.shuffle(out)
    return out + ["", None, " \t", "a", "A", "a b", "b a", "ü Ü é", "x y z " * 20000, "x y z " * 19999]


def collected(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("leaf", [256, 3])
def test_against_brute_force(spark, leaf):
    """With 3 members to a leaf most tree nodes of a group are branched to the last level and searched in cells."""
    texts = corpus()
    rows = [(None if i % 19 == 0 else 5000 - i, t) for i, t in enumerate(texts)]
    rows += rows[:5]
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows],
                                 "doc_id long, text string, id string, n_shingles int, key int")
    assert collected(minhash.near_duplicates(docs, leaf=leaf)) == sorted(brute(rows), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).collect() == []
    only = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert collected(minhash.near_duplicates(only)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_group_of_near_copies_larger_than_a_leaf(spark):
    """600 variants of one text: large tree nodes on all levels, few tests, and a member that
    only one of the variants links to the group."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(300)] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    bridge = rows[77][1].split()
    for at in range(5, 20):
        bridge[at] = "b"
    rows.append((1000, " ".join(bridge)))                    # near 77 and perhaps a few others
    rows.append((1001, " ".join(f"u{i}" for i in range(300))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(minhash.near_duplicates(docs)) == sorted(brute(rows), key=repr)


def test_survival_and_trees(spark):
    """Trees that share a node for a pair at the threshold, against the branching process."""
    rng = np.random.default_rng(1)
    trees = 64
    pairs = []
    for i in range(60):
        both = rng.integers(0, 1 << 62, 850, dtype=np.uint64)
        pairs += [(2 * i + s, np.unique(np.concatenate((both, rng.integers(0, 1 << 62, 75, dtype=np.uint64)))))
                  for s in (0, 1)]
    rows = [(i, bytearray(minhash.signature(s).tobytes())) for i, s in pairs]
    nodes = narrow(spark.createDataFrame(rows, "id long, sig binary"))
    keys = nodes.mapInArrow(minhash._children(minhash.BRANCH / (0.85 * minhash.WIDTH), trees), "key long, id long")
    shared = (keys.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"),
                                                 F.max("id").alias("b")).where("n = 2 and b = a + 1 and a % 2 = 0"))
    hit, total = shared.count(), 60 * trees
    # the number of shared children is about Poisson(branch) where the sets agree in 85 %
    assert abs(hit / total - minhash.BRANCH) < 0.12
    assert minhash.trees_for(0.9995) == 9 and 0.64 < minhash.survival(1.5, 3) < 0.66 and 0.58 < minhash.survival(1.5)
