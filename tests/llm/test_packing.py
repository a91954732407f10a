import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from tessera.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(texts, capacity=4096):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out += [(doc_id, p, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
                for p, at in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=repr)


def check_packed(rows, capacity=4096):
    """Gapless from 0 and within the capacity; the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_tokens_and_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.tokenize_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    rows = packing.pack(pieces).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    assert got == expected((r.doc_id, r.text) for r in docs.collect())
    assert check_packed(rows) <= np.ceil(sum(r.length for r in rows) / 4096) + 1


def test_word_cache_equals_the_tokenizer():
    texts = ["A  b\tc\n\nd,e f;g's don't 12ab .. ,a", "<|endoftext|> X <|ENDOFTEXT|>", "É Ê Ça ΣΑΣ e\u0301a e, \u0301x", "",
             "a\x1cb\x0bc\x85d\u2028e\u3000f", "$$$ x## &&& 5% q!?", "İstanbul ǅ ﬁ", "ÀÖØÞßàöøÿ×÷ªºµ Ñandú, ÜBER-ÄÖ! œuvre ﬀ"] * 2
    tokenizer, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH, cache_words=3)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for rows in (texts, texts[::-1], texts[:1]):
        ids, starts = own.ids(pa.array([t.encode() for t in rows], pa.binary()))
        got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
        assert got == [want[texts.index(t)] for t in rows]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=0, max_size=120))
def test_plan_places_each_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41)
    plan = packing.packing_plan(counts)
    load, seen = {}, {}
    for length, rank, m, sequence, offset in plan.tolist():
        for i in range(m):
            assert (length, rank + i) not in seen
            seen[length, rank + i] = True
            load.setdefault(sequence + i, []).append((offset, length))
    assert len(seen) == len(lengths) and all(r < counts[x] for x, r in seen)
    for own in load.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 40
    # any-fit bound: at most one sequence is at most half full
    assert sum(sum(x for _, x in own) <= 20 for own in load.values()) <= 1


def test_exact_complements_fill_sequences():
    counts = np.zeros(101, int)
    for lengths, m in (([60, 40], 5), ([50, 30, 20], 7), ([55, 25, 15, 5], 3), ([100], 4)):
        for x in lengths:
            counts[x] += m
    plan = packing.packing_plan(counts)
    assert plan[:, 3].max() + 1 <= 5 + 7 + 3 + 4 + 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "hello there"), (3, "same"), (3, "same"), (4, "long word " * 30000),
            (5, "<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, 5, "s", 9) for i, t in rows],
                                 "doc_id long, text string, length int, rank string, sequence_id int")
    pieces = packing.tokenize_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    got = packing.pack(pieces).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected(rows)
    check_packed(got)
    assert packing.pack(packing.tokenize_pieces(docs.limit(0)).drop("ids")).collect() == []
