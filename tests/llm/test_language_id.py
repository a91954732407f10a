import numpy as np
from pyspark.sql import functions as F

from conftest import SF
from tessera.llm import language_id
from tessera.llm.common import id_bucket

SCHEMA = "doc_id long, text string, lang string, score string, held_out string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify_language(docs, id_bucket(F.col("doc_id"), 5) == 0).join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert len(held) > 20 and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_slices_give_the_same_features(monkeypatch):
    text = "Ça va très bien, merci! ÀÉ 123 " * 50
    whole = np.sort(np.concatenate(list(language_id.features(text))))
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert (np.sort(np.concatenate(list(language_id.features(text)))) == whole).all()
    # n-grams of 1 .. N code points over " letters ": a rolling count
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    n = len(" ".join(letters.split())) + 2
    assert len(whole) == sum(n - k + 1 for k in range(1, language_id.N + 1))


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "123 !!", "fr"),
            (5, "", None), (None, "the dog", None), (None, "the dog", None), (7, "le chien " * 100_000, "fr")]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify_language(docs, F.lit(False)).collect()}
    assert got == {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (7, "fr")}
    nothing = language_id.identify_language(docs, F.lit(True)).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(rows)
    assert language_id.identify_language(docs.limit(0), F.lit(False)).collect() == []
