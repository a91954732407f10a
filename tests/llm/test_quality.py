import random
import re
from collections import Counter

import numpy as np

from conftest import SF
from tessera.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, score string, kept int, n_words string"


def brute(text):
    text = text or ""
    words = W.findall(text)
    lines = [x for x in text.split("\n") if W.search(x)]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b#", "é|", "x\n", "\x0b", "\x1c", "😀$", "a\na\n"]) for _ in range(rng.randint(0, 60))))
            for i in range(200)] + [(None, None), (500, ""), (501, "one two three four five six seven eight " * 9000),
                                    (502, "same"), (502, "same")]
    docs = spark.createDataFrame([(*r, "s", 1, "n") for r in rows], SCHEMA)
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, good int")
    got = quality.judge_quality(docs, labels).collect()
    want = []
    for i, t in rows:
        b = brute(t)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        want.append((i, *b, failed, not failed))
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                    r.kept) for r in got), key=repr) == sorted(want, key=repr)
    assert quality.judge_quality(docs.limit(0), labels).collect() == []


def test_labelled_documents_are_separated(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet")
    got = quality.judge_quality(docs, labels.withColumnRenamed("quality", "good").select("doc_id", "good")) \
        .join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2
    assert all(not r.kept for r in got if r.base_failed)


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    rows = np.concatenate((rng.normal(0, 1, (2000, 3)), rng.normal(9, .5, (20, 3))))
    score = quality.IsolationForest(rows).score(rows)
    assert score[2000:].min() > np.quantile(score[:2000], 0.98)
    assert (score > 0).all() and (score < 1).all()


def test_without_good_labels_the_base_rules_decide(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(40)) + " #" * (i % 5)) for i in range(50)],
                                 "doc_id long, text string")
    bad = spark.createDataFrame([(i, 0) for i in range(25)], "doc_id long, good int")
    got = quality.judge_quality(docs, bad).collect()
    assert len(got) == 50 and all(r.kept for r in got)


def test_verdicts_do_not_depend_on_the_layout(spark):
    folder = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))                     # repeated rows
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "good").select("doc_id", "good")

    def verdicts(d, m, **how):
        return sorted(((r.doc_id, r.score, r.kept) for r in quality.judge_quality(d, m, **how).collect()), key=repr)

    for how in ({}, {"fit_rows": 300}):
        first = verdicts(docs.repartition(7), labels, **how)
        assert first == verdicts(docs.repartition(3, "text"), labels.repartition(5), **how)
        assert first == verdicts(docs.orderBy("text").coalesce(1), labels.orderBy("good"), **how)
        assert len({s for _, s, _ in first}) > 100
