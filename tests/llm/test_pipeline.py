import re

import numpy as np

import corpus_pipeline
from conftest import SF
from test_packing import check_packed, expected


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert [n.split()[0] for n in names] == ["quality", "line", "simhash", "mixing", "best-fit"]
    stage = dict(zip(("quality", "line", "near", "mix", "pack"), (f for _, f in corpus_pipeline.STAGES)))

    good = stage["quality"](spark, docs, SF).cache()
    assert good.columns == docs.columns
    for r in good.collect():
        assert len(r.text.split()) >= 20
    assert 0.8 * docs.count() < good.count() < docs.count()

    lines = stage["line"](spark, good, SF).cache()
    assert lines.columns == docs.columns and lines.count() == good.count()
    whole = {r.doc_id: r.text for r in good.collect()}
    for r in lines.collect():                               # what is left is a subsequence of the lines
        rest = iter(re.split(r"(?<=\n)|(?<=[.!?] )", whole[r.doc_id]))
        assert all(x in rest for x in re.split(r"(?<=\n)|(?<=[.!?] )", r.text) if x)

    from test_simhash import brute_fingerprint, brute_roots
    near = stage["near"](spark, lines, SF).cache()
    rows = lines.collect()
    roots = brute_roots([brute_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(roots))

    mixed = stage["mix"](spark, near, SF).cache()
    assert mixed.columns == docs.columns
    sizes = {}
    for r in near.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    from test_mixing import brute_targets
    for s, target in brute_targets(sizes, (1, 2, 3), 3.0).items():
        taken = sum(len(r.text.split()) for r in mixed.collect() if r.source == s)
        assert abs(taken - target) < 0.15 * target + 20

    packed = stage["pack"](spark, mixed, SF).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=repr) == \
        expected((r.doc_id, r.text) for r in mixed.collect())
    assert check_packed(packed) <= np.ceil(sum(r.length for r in packed) / 4096) + 1
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in ran) == sorted((r.doc_id, r.piece, r.length) for r in packed)


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 300, None, "s", 5),
            (2, "word " * 300, None, "s", 5), (3, " ".join(f"w{i}" for i in range(50)), "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, lang string, source string, "
                                 "n_chars long, component_id string, size int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept = out.collect()
        if not name.startswith("best-fit"):
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).collect() == []
        if name.startswith("simhash"):
            assert len(kept) == 3
