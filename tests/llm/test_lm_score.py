import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tessera.llm import lm_score
from tessera.llm.common import id_bucket


def in_test():
    return id_bucket(F.col("doc_id"), 7) == 2


def brute(rows):
    own = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in own}
    c = Counter(w for i in own if not held[i] for w in own[i])
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for i, w in own.items()}


@pytest.mark.parametrize("table_words", [50, 1 << 17])
def test_base_against_brute_force(spark, table_words):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lm_score.score_documents(docs, in_test(), table_words=table_words, cluster_words=200, class_words=1000, classes=16).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(want)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
        assert r.score < 0
    if table_words > 50:                  # the class model predicts unseen documents better than the unigram base
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def likelihood(pairs, group):
    k = group.max() + 1
    table = np.zeros((k, k))
    np.add.at(table, (group[:, None].repeat(len(group), 1), group[None].repeat(len(group), 0)), pairs)
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return f(table) - f(table.sum(1)) - f(table.sum(0))


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    of = np.arange(60) % 4                                        # four planted classes in a cycle
    pairs = rng.poisson(np.where((of[:, None] + 1) % 4 == of[None], 6.0, 0.2)).astype(float)
    order = rng.permutation(60)
    pairs, of = pairs[order][:, order], of[order]
    before = likelihood(pairs, np.arange(60) % 4)
    group, table = lm_score.exchange_classes(pairs, 4, sweeps=10)
    onehot = np.eye(4)[group]
    assert np.allclose(table, onehot.T @ pairs @ onehot)
    assert likelihood(pairs, group) > before
    assert len({(a, b) for a, b in zip(of.tolist(), group.tolist())}) == 4     # the classes are found


def test_each_exchange_move_is_the_best():
    rng = np.random.default_rng(8)
    pairs = rng.poisson(1.0, (12, 12)).astype(float)
    group, _ = lm_score.exchange_classes(pairs, 3, sweeps=50)
    at = likelihood(pairs, group)
    for w in range(12):
        for c in range(3):
            other = group.copy()
            other[w] = c
            if len(set(other.tolist())) == 3:
                assert likelihood(pairs, other) <= at + 1e-6


def test_a_further_token_goes_to_its_best_class():
    rng = np.random.default_rng(9)
    pairs = rng.poisson(2.0, (31, 31)).astype(float)
    pairs[30, 30] = 0
    group, table = lm_score.exchange_classes(pairs[:30, :30], 4, sweeps=20)
    onehot = np.eye(4)[group]
    got = lm_score.best_classes(table, pairs[30:, :30] @ onehot, pairs[:30, 30:].T @ onehot)
    all_of = [likelihood(pairs, np.append(group, c)) for c in range(4)]
    assert int(got[0]) == int(np.argmax(all_of))


def test_context_counts(spark):
    texts = spark.createDataFrame([(b"a x b x",), (b"x x a",)], "t binary")
    index = {b"a": 0, b"b": 1, b"\n": 2, b"x": 3}
    right, left = lm_score.context_counts(texts, index, np.array([0, 1, 1]), 2)
    # x is followed by b, the end, x, a and preceded by a, b, the start, x
    assert right.tolist() == [[1.0, 2.0]] and left.tolist() == [[1.0, 2.0]]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "A a \n b"), (None, "a"), (4, "b c " * 20000), (4, "b c " * 20000)]
    docs = spark.createDataFrame([(*r, 1, "s", "w") for r in rows], "doc_id long, text string, n_tokens int, score string, w string")
    got = lm_score.score_documents(docs, F.col("doc_id") == 3).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 1), (2, 1), (3, 4), (4, 40001), (4, 40001)]
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert lm_score.score_documents(docs.limit(0), F.col("doc_id") == 3).collect() == []
    nothing = lm_score.score_documents(docs, F.lit(True)).collect()
    assert len(nothing) == 6 and all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in nothing)


def test_open_neighbours_count_and_the_best_class_is_chosen():
    rng = np.random.default_rng(10)
    pairs = rng.poisson(3.0, (40, 40)).astype(float)                    # tokens 30 to 39 have no class yet
    inner = np.pad(pairs[:30, :30], (0, 1))
    inner[:30, 30], inner[30, :30] = pairs[:30, 30:].sum(1), pairs[30:, :30].sum(0)
    inner[30, 30] = pairs[30:, 30:].sum()
    group, table = lm_score.exchange_classes(inner, 4, sweeps=20, fixed=1)
    full = np.append(group, np.full(10, 4))
    assert group.max() < 4 and table.sum() == pairs.sum()                # no bigram is dropped
    onehot = np.eye(5)[full]
    right, left = pairs[30:] @ onehot, pairs[:, 30:].T @ onehot
    own = np.diagonal(pairs)[30:, None]
    right, left = (np.hstack([x - own * (np.arange(5) == 4), own]) for x in (right, left))
    got = lm_score.best_classes(table, right, left)
    for i in range(10):
        every = []
        for c in range(4):
            other = full.copy()
            other[30 + i] = c
            every.append(likelihood(pairs, other))
        assert int(got[i]) == int(np.argmax(every))


def test_all_tokens_get_their_class_from_their_neighbours(spark):
    rng = np.random.default_rng(11)
    nouns, verbs = [f"n{i}" for i in range(300)], [f"v{i}" for i in range(300)]
    weight = 1 / np.arange(1, 301)
    texts = [" ".join(w for _ in range(150) for w in (rng.choice(nouns, p=weight / weight.sum()),
                                                      rng.choice(verbs, p=weight / weight.sum()))) for _ in range(60)]
    train = spark.createDataFrame([(t.encode(),) for t in texts], "t binary").repartition(5)
    counts = lm_score.token_counts(train).cache()
    model, others = lm_score.fit(train, counts, 40, 10, 20, 3, 10)      # ranks 11 to 20 at once, then all others in Spark
    exact = {bytes(r.w): r.n for r in counts.collect()}
    found = {bytes(r.w): (r.n, r.c) for r in others.collect()}
    table = {w: int(model.of[i]) for w, i in model.index.items()}
    assert len(found) == len(exact) - 20 and all(n == exact[w] for w, (n, _) in found.items())
    assert len(table) <= 41 and all(found[w][1] == c for w, c in table.items() if w in found)
    assert model.n_tokens == sum(exact.values()) and model.n_types == len(exact)
    of = table | {w: c for w, (_, c) in found.items()}
    by = {kind: [of[w.encode()] for w in words if w.encode() in of] for kind, words in (("n", nouns), ("v", verbs))}
    share = {kind: max(map(c.count, set(c))) / len(c) for kind, c in by.items()}
    assert min(share.values()) > .9 and max(by["n"], key=by["n"].count) != max(by["v"], key=by["v"].count)


def test_score_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    rows = docs.withColumn("t", F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary")))
    train = rows.where(~in_test())
    counts = lm_score.token_counts(train).cache()
    params = (100, 30, 60, 8, 4)                                         # most tokens are outside the table
    model, others = lm_score.fit(train, counts, *params)
    of = {bytes(r.w): r.c for r in others.collect()} | {w: int(model.of[i]) for w, i in model.index.items()}
    n = {bytes(r.w): r.n for r in counts.collect()}
    own = {r.doc_id: [b"\n", *(r.text or "").encode().lower().split(), b"\n"] for r in docs.collect()}
    pairs = np.zeros((8, 8))
    for i, w in own.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            np.add.at(pairs, ([of[x] for x in w[:-1]], [of[x] for x in w[1:]]), 1)
    step = model.transitions(pairs)
    assert np.allclose((10 ** step).sum(axis=1), 1, atol=.05)
    want = {i: sum(step[of.get(a, 8), of.get(b, 8)] + (math.log10((n[b] + 1) / (model.mass[of[b]] + model.types[of[b]] + 1))
                                                       if b in of else 0) for a, b in zip(w, w[1:])) for i, w in own.items()}
    got = lm_score.score_documents(docs, in_test(), *params).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(want)
    assert any(x not in of for w in own.values() for x in w)


def test_texts_are_cut_into_tokens_twice(spark):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        cut.add(1)
        return text

    docs = spark.createDataFrame([(i, f"a b{i % 9} c{i} b{i % 7} a") for i in range(70)], "doc_id long, text string")
    got = lm_score.score_documents(docs.withColumn("text", read("text")), in_test(), 20, 5, 10, 3).collect()
    assert len(got) == 70 and cut.value <= 2 * 70             # to count and to number the tokens


def test_open_contexts_leave_a_task_once_per_token(spark):
    texts = spark.createDataFrame([("x y r a y r x".encode(),), ("s s s r".encode(),)] * 40, "t binary").coalesce(1)
    index = {lm_score.END: 0, b"x": 1, b"y": 2}
    numbered = lm_score.number_tokens(texts, index)
    got = lm_score.open_contexts(numbered, list(index), np.array([0, 1]), 2).collect()
    codes = {bytes(r.w): Counter(r.codes) for r in got}
    assert len(got) == len(codes) == 4
    # before * 4 + after: 0 the end, 1 x, 2 open, 3 the token itself
    assert codes == {b"y": {1 * 4 + 2: 40, 2 * 4 + 2: 40}, b"a": {2 * 4 + 2: 40}, b"r": {2 * 4 + 2: 40, 2 * 4 + 1: 40, 2 * 4 + 0: 40},
                     b"s": {0 * 4 + 3: 40, 3 * 4 + 3: 40, 3 * 4 + 2: 40}}
    pairs = lm_score.pair_table(lm_score.class_pairs(numbered, np.array([0, 1, 2, 2]), 3), 3)
    assert pairs.sum() == 40 * (8 + 5) and pairs[0].tolist() == [0, 40, 40] and pairs[1].tolist() == [40, 0, 40]


def test_tokens_that_occur_once_go_to_their_best_class():
    rng = np.random.default_rng(12)
    k, wide = 5, 7
    table = rng.poisson(50.0, (k + 1, k + 1)).astype(float)
    codes = [rng.integers(0, k + 1, n) * wide + rng.integers(0, k + 1, n) for n in rng.integers(1, 4, 300)]
    words = [b"%03d" % i for i in range(300)]
    rows = [(w, part) for w, c in zip(words, codes) for part in np.array_split(c, 1 + len(c) // 2)]     # a task each
    batches = [pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows[i:i + 7]], pa.binary()),
                                           pa.array([c.astype(np.uint8).tobytes() for _, c in rows[i:i + 7]], pa.binary())],
                                          ["w", "codes"]) for i in range(0, len(rows), 7)]
    shared = type("Shared", (), {"value": table})
    got = pa.Table.from_batches(lm_score._choose(shared)(iter(batches))).to_pydict()
    assert got["w"] == words and got["n"] == [len(c) for c in codes]
    counts = lambda near: np.array([np.bincount(x, minlength=wide) for x in near]).astype(float)
    want = lm_score.best_classes(table, counts([c % wide for c in codes]), counts([c // wide for c in codes]))
    assert got["c"] == want.tolist()
