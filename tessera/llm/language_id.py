"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and all
n-grams of 1 to ``N`` code points are hashed to ``dim`` features.  Training
counts features per language in tasks (one dense partial count vector per
language and task), sums them in Spark and turns them into a matrix of
log-probabilities, languages x ``dim``: a few MB, whatever the corpus size.
The matrix is broadcast; scoring gathers its columns in numpy, in slices of
bounded length, over whole texts.

Defined results: a null text, or one without any letter, is ``und`` with
score 0; ties between languages go to the first in code-point order; rows
with a null id take part in learning and are not held out; with nothing to
learn from every text is ``und``; repeated rows get equal results; more than
``MAX_LANGUAGES`` languages to learn are an error, since the matrix that is
broadcast grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, narrow

N = 4                     # longest n-gram
DIM = 1 << 17             # hashed features
SLICE = 1 << 18           # code points that are expanded at once
MAX_LANGUAGES = 100       # bounds the broadcast matrix to MAX_LANGUAGES * DIM floats
UNKNOWN = "und"


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, runs of other characters as one 0."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_letter = (points >= 97) & (points <= 122)
    high = points >= 128
    if high.any():
        wide = np.unique(points[high])
        yes = wide[[chr(c).isalpha() for c in wide.tolist()]]
        ascii_letter |= np.isin(points, yes)
    points = np.where(ascii_letter, points, 0)
    keep = (points != 0) | np.concatenate(([True], points[:-1] != 0))
    return points[keep]


def features(text: str, dim: int = DIM) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, in slices; nothing for a text without a letter."""
    points = _letters(text)
    if not points.any():
        return
    points = np.concatenate(([0], np.trim_zeros(points), [0])).astype(np.uint64)
    for start in range(0, len(points), SLICE):
        part = points[start:start + SLICE + N - 1]         # the overlap belongs to the n-grams that start here
        starts = min(SLICE, len(points) - start)
        code, found = np.zeros(len(part), np.uint64), []
        for n in range(1, N + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            code = code[:m] * np.uint64(0x100000001B3) + part[n - 1:n - 1 + m] + np.uint64(n)
            mixed = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(40)).astype(np.int64)[:starts] % dim)
        yield np.concatenate(found)


def _counts(dim: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                have = sums.setdefault(lang.as_py(), np.zeros(dim, np.int64))
                for f in features(text.as_py(), dim):
                    have += np.bincount(f, minlength=dim)
        for lang, have in sums.items():
            at = np.flatnonzero(have)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)),
                                                  pa.array(have[at])], ["lang", "feature", "n"])
    return count


def learn(labelled: DataFrame, dim: int = DIM, alpha: float = 0.1) -> tuple[list[str], np.ndarray]:
    """Languages and their (features x languages) log-probabilities from all rows of (text, lang)."""
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    seen = labelled.select("lang").where(F.col("lang").isNotNull()).distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(seen) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    partial = rows.mapInArrow(_counts(dim), "lang string, feature int, n long")
    with arrow_batches(labelled.sparkSession):
        total = partial.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()   # <= languages * dim rows
    langs = sorted(total["lang"].unique())
    counts = np.zeros((dim, len(langs)))
    for i, lang in enumerate(langs):
        own = total[total["lang"] == lang]
        counts[own["feature"], i] = own["n"]
    logs = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * dim) if langs else counts
    return langs, logs.astype(np.float32)


def _predict(langs: list[str], shared, dim: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in batches:
            names, scores = [], []
            for text in batch.column(batch.num_columns - 1):
                text, total, n = text.as_py(), np.zeros(len(langs)), 0
                for f in features(text, dim) if text and langs else ():
                    total += logs[f].sum(axis=0, dtype=np.float64)
                    n += len(f)
                if not n:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(total.argmax())
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))     # posterior under equal priors
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])
    return predict


def identify_language(docs: DataFrame, held_out: Column, dim: int = DIM) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``; learns from rows not ``held_out``."""
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text", "lang")
    langs, logs = learn(rows.where(~F.col("held_out")), dim)
    shared = docs.sparkSession.sparkContext.broadcast(logs)
    ids = rows.schema["doc_id"].dataType.simpleString()
    with arrow_batches(docs.sparkSession):
        return narrow(rows.select("doc_id", "held_out", "text").mapInArrow(
            _predict(langs, shared, dim), f"doc_id {ids}, held_out boolean, lang_pred string, score double"))
