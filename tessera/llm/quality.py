"""Quality rules judged by an isolation forest on rule statistics.

One pass over whole texts counts the rule statistics.  Documents that fail a
hard rule (too few words, or too many words in repeated windows) are
rejected.  The others are judged by an isolation forest on scale-free ratios
of the statistics (word length, symbols and marks per word; repeats are left
to the hard rule): trees split random samples of labelled documents at
random, and a document that is separated after short paths is an anomaly.
The forest is fitted on a bounded sample (about ``fit_rows`` distinct labelled
rows by hash, twice that at most), taken and ordered by the rows' values alone,
so that verdicts do not depend on how the table is partitioned; the threshold
is calibrated on all labelled documents, from a histogram of their scores: the one with the
largest (share of bad rejected) - ``good_cost`` * (share of good rejected)
among those that reject at most ``good_loss`` of the good ones.

Defined results: a null text has no words and fails the base rule; null
doc_ids join no label; a document with several labels counts as good only if
all its labels are good; without labelled good documents no forest is fitted
and all that pass the base rules are kept; repeated rows get equal results,
and count once for the forest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, narrow, text_bytes, uniform

SYMBOLS = b"#*$%&|<>"                     # fixed value
WINDOW = 8                                # words in a repeated window
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    grams = [flat[a:b] for a, b in zip([0, *ends[:n - 1].tolist()], (ends[window - 1:] - 1).tolist())]
    if len(set(grams)) == n:
        return 0
    first, again = {}, np.zeros(n, bool)
    for i, g in enumerate(grams):
        j = first.setdefault(g, i)
        if j != i:
            again[i] = again[j] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics_of(text: bytes) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one UTF-8 text."""
    words = text.split()
    flat = b"".join(words)
    raw = np.frombuffer(flat, np.uint8)
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = lambda chars: len(flat) - len(flat.translate(None, chars))
    return (len(words), int(((raw & 0xC0) != 0x80).sum()), count(SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), count(b"!?"))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics_of(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], ["doc_id", *COUNTS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS..., base_failed) per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = docs.select("doc_id", text_bytes(F.col("text")).alias("t")).mapInArrow(
        _statistics, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    return counts.withColumn("base_failed", (F.col("n_words") < 20)
                             | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """rows x features, free of a text's length."""
    c = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words = np.maximum(c["n_words"], 1)
    return np.column_stack([c["word_chars"] / words, c["n_symbols"] / words, c["n_marks"] / words])


class IsolationForest:
    """Random split trees as flat arrays; score 2^(-mean path / expected path), in (0, 1)."""

    def __init__(self, rows: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.depth = max(1, int(np.ceil(np.log2(max(2, min(sample, len(rows)))))))
        self.norm = self._average_path(min(sample, len(rows)))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((trees, size), -1, np.int16)
        self.cut = np.zeros((trees, size))
        self.path = np.zeros((trees, size))
        for t in range(trees):
            pick = rng.choice(len(rows), min(sample, len(rows)), replace=False)
            self._grow(rng, t, 0, 0, rows[pick])

    @staticmethod
    def _average_path(n: int) -> float:
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def _grow(self, rng, tree: int, node: int, depth: int, rows: np.ndarray) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        wide = np.flatnonzero(high > low)
        self.path[tree, node] = depth + self._average_path(len(rows))
        if depth == self.depth or len(rows) < 2 or not len(wide):
            return
        f = int(rng.choice(wide))
        cut = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.cut[tree, node] = f, cut
        left = rows[:, f] < cut
        for child, part in ((2 * node + 1, rows[left]), (2 * node + 2, rows[~left])):
            if len(part):
                self._grow(rng, tree, child, depth + 1, part)
            else:
                self.path[tree, child] = depth + 1

    def score(self, rows: np.ndarray) -> np.ndarray:
        total, at = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, path in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[at, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(self.norm, 1e-9))


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            got = forest.score(ratios({c: batch.column(c).to_numpy() for c in COUNTS}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*batch.schema.names, "score"])
    return run


def _with_scores(rows: DataFrame, shared) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_scores(shared), f"{kinds}, score double")


def threshold(scored: DataFrame, good_loss: float, good_cost: float, bins: int = 10_000) -> float:
    """The score from which documents are rejected, from all (score, good) rows."""
    bin_ = F.floor(F.col("score") * bins).cast("int")
    table = scored.groupBy(bin_.alias("bin"), "good").agg(F.count(F.lit(1)).alias("n")).toPandas()  # <= 2 * bins rows
    good, bad = np.zeros(bins + 2), np.zeros(bins + 2)
    for b, g, n in table.itertuples(index=False):
        (good if g else bad)[b] += n
    lost = good[::-1].cumsum()[::-1]                    # good documents at or above each bin
    fits = np.flatnonzero(lost <= good_loss * good.sum())
    caught = bad[::-1].cumsum()[::-1] / max(bad.sum(), 1) - good_cost * lost / max(good.sum(), 1)
    best = np.flatnonzero(caught[fits] == caught[fits].max())[-1]          # the highest of the equally good
    return float(fits[best] / bins)


def judge_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, good_loss: float = 0.02,
                  good_cost: float = 10.0, key: str = "doc_id") -> DataFrame:
    """(doc_id, COUNTS..., base_failed, score, kept) per row of ``docs`` (doc_id, text);
    ``labels`` has (doc_id, good 0/1), matched with ``key``, doc_id or a field of it."""
    with arrow_batches(docs.sparkSession):
        stats = narrow(rule_statistics(docs))
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("good").isNotNull())
             .groupBy("doc_id").agg((F.min("good") > 0).alias("good")).withColumnRenamed("doc_id", "_d"))
    known = stats.where(~F.col("base_failed")).join(marks, F.col(key) == F.col("_d")).drop("_d")
    drawn = known.select(uniform(key, *COUNTS).alias("_h"), *COUNTS).distinct()
    n_good = known.agg(F.count_if("good")).first()[0]
    if not n_good:
        return stats.withColumn("score", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    sample = (drawn.where(F.col("_h") * drawn.count() < fit_rows).orderBy("_h", *COUNTS).limit(2 * fit_rows)
              .select(*COUNTS).toPandas())
    if not len(sample):                                   # a handful of rows, none of them drawn
        sample = drawn.orderBy("_h", *COUNTS).limit(1).select(*COUNTS).toPandas()
    forest = IsolationForest(ratios({c: sample[c].to_numpy() for c in COUNTS}))
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    limit = threshold(_with_scores(known.drop("doc_id", "base_failed"), shared).select("score", "good"),
                      good_loss, good_cost)
    return _with_scores(stats, shared).withColumn("kept", ~F.col("base_failed") & (F.col("score") < limit))
