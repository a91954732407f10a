"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (at most ``capacity`` counters) goes to
the driver, where the plan is made on counts: lengths are taken in descending
order, and the gap each leaves is looked up in hashed sums of one, two and
three available lengths that fill it exactly; combinations are consumed as
often as their availability counts allow, and what has no exact complement is
filled by best fit (the largest length that fits, again and again).  A plan
entry says "the next m pieces of this length go to sequences s .. s+m-1 at
this offset"; there are at most a few per length and consumed combination,
whatever the number of pieces.  Pieces get their rank within their length
from counts per (length, hash bucket) with about sqrt(n) buckets, and find
their entry by binary search in the broadcast plan.

Tokens of a white-space-separated word do not depend on its neighbours, so
words are tokenized once per worker and kept in a bounded cache; texts that
hold a special-token mark are tokenized whole.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are packed one by one (equal rows are interchangeable); a null
doc_id is packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, narrow, slices, text_bytes

CACHE_WORDS = 400_000                     # words in one generation of a worker's cache; it keeps two
TAIL = b".,;:!?%&$#*|-"                   # punctuation that is a piece of its own after a letter
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
# Letters of Latin-1: composed, and with one lower-case letter each
LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """How the byte-level alphabet writes the lower-case letters of Latin-1: printable
    Latin-1 bytes stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


class WordTokenizer:
    """Token ids of UTF-8 texts as little-endian 32-bit bytes, by words with a cache.

    A word of Latin letters only is one piece for the tokenizer, so it goes to its
    model directly; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = _byte_letters()
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.limit = cache_words

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _piece(self, word: bytes) -> bytes | None:
        """Ids of a word (A-Z lower-cased) that is one run of Latin letters, else None."""
        piece = word.decode("utf-8", "replace")
        if not word.isalpha():
            if not LATIN(piece):
                return None
            piece = piece.lower().translate(self.alphabet)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.model.tokenize(piece)])

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        if len(self.cache) > self.limit:                     # words in use come back from the older generation
            self.older, self.cache = self.cache, {}
        cache, older, new, whole = self.cache, self.older, {}, []
        for w in words:
            ids = older.get(w)
            if ids is None:
                stem = w.rstrip(TAIL)
                if len(stem) == len(w):
                    ids = self._piece(w)
                elif stem and stem[-1] in LETTERS:
                    ids = cache.get(stem) or older.get(stem) or new.get(stem) or self._piece(stem)
                    if ids is not None:
                        tail = w[len(stem):]
                        if tail not in cache:
                            cache[tail] = self._encode([tail.decode()])[0]
                        new[stem] = ids
                        ids += cache[tail]
            if ids is None:
                whole.append(w)
            else:
                new[w] = ids
        if whole:
            new.update(zip(whole, self._encode([w.decode("utf-8", "replace") for w in whole])))
        cache.update(new)
        return new

    def lookup(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.cache.get, words))
        new = {w for w, ids in zip(words, found) if ids is None}
        if not new:
            return found
        learnt = self._learn(new)
        return [learnt[w] if ids is None else ids for w, ids in zip(words, found)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (UTF-8, no nulls) in one array, and where each text's begin.

        Words are split, made distinct and put together again by whole columns; only
        the distinct words of the batch are looked up one by one."""
        texts = texts.view(pa.string())
        lower = pc.ascii_lower(texts)
        whole = np.zeros(len(texts), bool)
        for mark in self.special:
            whole |= np.asarray(pc.match_substring(lower, mark)) | np.asarray(pc.match_substring(texts, mark))
        if whole.any():
            lower = pc.if_else(pa.array(whole), "", lower)
        lists = pc.ascii_split_whitespace(lower)
        words = lists.flatten().dictionary_encode()
        known = self.lookup(words.dictionary.view(pa.binary()).to_pylist())
        flat = np.frombuffer(b"".join(known), "<u4")
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(size) - size
        code = words.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        ends = np.cumsum(n)
        ids = flat[np.arange(n.sum()) + np.repeat(first[code] - (ends - n), n)]
        starts = np.concatenate(([0], ends))[lists.offsets.to_numpy()]
        if whole.any():
            parts = [np.frombuffer(self._encode([t.as_py()])[0], "<u4") if w else ids[a:b]
                     for t, w, a, b in zip(texts, whole, starts, starts[1:])]
            ids = np.concatenate(parts)
            starts = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return ids, starts


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _cut(path: str | None, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path is None:
            import public_tokenizers
            where = public_tokenizers.path("word_bpe_49k.json")
        else:
            where = path
        tokenizer = _TOKENIZERS.get(where)
        if tokenizer is None:
            tokenizer = _TOKENIZERS[where] = WordTokenizer(where)
        for batch in slices(batches, 1024):                      # bounds the ids that are held at once
            ids, starts = tokenizer.ids(batch.column(1))
            ids = np.insert(ids, starts[1:], end_id).astype("<u4")
            starts = starts + np.arange(len(starts))             # with the end ids before each text
            pieces = -(-np.diff(starts) // capacity)
            row = np.repeat(np.arange(batch.num_rows), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at = starts[row] + piece * capacity
            bounds = pa.py_buffer((4 * np.append(at, starts[-1])).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                 pa.array(piece * capacity), pa.array(np.diff(np.append(at, starts[-1]))),
                 pa.Array.from_buffers(pa.binary(), len(row), [None, bounds, pa.py_buffer(ids.tobytes())])],
                ["doc_id", "piece", "start", "length", "ids"])
    return cut


def tokenize_pieces(docs: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """(doc_id, piece, start, length, ids): the token ids of every text and ``end_id``,
    cut every ``capacity`` tokens; ``ids`` are little-endian unsigned 32-bit numbers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes(F.col("text")).alias("text")).mapInArrow(
        _cut(path, end_id, capacity), f"doc_id {kind}, piece int, start long, length long, ids binary")


def packing_plan(counts: np.ndarray) -> np.ndarray:
    """Rows (length, first rank, m, first sequence, offset) for ``counts[length]`` pieces.

    ``len(counts) - 1`` is the capacity.  Every piece is in exactly one row.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    plan, sequence = [], 0

    def take(lengths: list[int], m: int) -> None:
        nonlocal sequence
        offset = 0
        for x in lengths:
            plan.append((x, used[x], m, sequence, offset))
            used[x] += m
            left[x] -= m
            offset += x
        sequence += m

    def often(lengths: list[int]) -> int:
        return min(int(left[x]) // lengths.count(x) for x in set(lengths))

    def pair(gap: int, most: int) -> list[int] | None:
        """Two available lengths with sum ``gap``, none above ``most``, the larger as large as can be."""
        hi = np.arange(min(most, gap - 1), (gap + 1) // 2 - 1, -1)
        if not len(hi):
            return None
        lo = gap - hi
        ok = (left[hi] > 0) & (left[lo] > 0) & ((hi != lo) | (left[hi] > 1))
        at = int(ok.argmax())
        return [int(hi[at]), int(lo[at])] if ok[at] else None

    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1                        # one is set aside while its partners are looked up
            gap, found = capacity - length, None
            if not gap:
                found = []
            elif left[gap]:
                found = [gap]
            else:
                found = pair(gap, length)
                if not found:
                    avail = np.flatnonzero(left[1:min(gap - 1, length + 1)]) + 1
                    for x in avail[::-1].tolist():
                        if 3 * x < gap:
                            break
                        left[x] -= 1
                        two = pair(gap - x, x)
                        left[x] += 1
                        if two:
                            found = [x, *two]
                            break
            left[length] += 1
            if found is None:                        # best fit: the largest that fits, until nothing does
                found, room, spare = [], gap, left.copy()
                spare[length] -= 1
                while room and (fits := np.flatnonzero(spare[:room + 1])).size:
                    x = int(fits[-1])
                    n = min(int(spare[x]), room // x)
                    found += [x] * n
                    spare[x] -= n
                    room -= x * n
            lengths = [length, *found]
            take(lengths, often(lengths))
    return np.array(plan, np.int64).reshape(-1, 5)


def _place(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value                          # sorted by (length, first rank)
        starts = (plan[:, 0] << 40) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, (length.astype(np.int64) << 40) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(plan[at, 3] + rank - plan[at, 1]), pa.array(plan[at, 4])],
                [*batch.schema.names, "sequence_id", "offset"])
    return place


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with sequence_id and offset.

    The rows are written to the shared folder once, so keep wide columns out.
    """
    names = [c for c in pieces.columns if c != "length"]
    with arrow_batches(pieces.sparkSession):
        rows = narrow(pieces.select(F.struct(*names).alias("row"), "length",
                                         F.xxhash64("length", *names).alias("h")))
    histogram = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()      # <= capacity rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        counts[r["length"]] = r["n"]
    plan = packing_plan(counts)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast(plan)
    buckets = int(max(1, np.ceil(np.sqrt(counts.sum()))))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("_l"), F.col("bucket").alias("_b"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("h", "row")
    ranked = (rows.withColumn("i", F.row_number().over(within) - 1)
              .join(sizes, (F.col("length") == F.col("_l")) & (F.col("bucket") == F.col("_b")))
              .select("row.*", "length", (F.col("base") + F.col("i")).alias("rank")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)
    return ranked.mapInArrow(_place(shared), f"{kinds}, sequence_id long, offset long").drop("rank")
