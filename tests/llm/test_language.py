from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quarrystone.llm import language

DATA = "/root/testdata/sf0.001"


def test_counting_trigrams_equals_bundling_each_one():
    text = "Der Hund, die Katze"
    grams = language.trigrams(text)
    values, n = language._counts(grams)
    whole = language.gram_vectors(grams, 64).astype(int).sum(axis=0)
    assert (n @ language.gram_vectors(values, 64).astype(int) == whole).all()
    assert len(grams) == len("DerHunddieKatze")


def test_prediction_is_the_nearest_prototype(documents):
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate([("aba abab", "x"), ("cdc dcdc", "y")] * 3)])
    prototypes = [(r.lang, list(r.vector)) for r in language.train(docs).collect()]
    assert {lang for lang, _ in prototypes} == {"x", "y"}
    for row in language.predict(documents(["abab", "dcd", "12 34", None]), prototypes).collect():
        if row.doc_id > 1:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        bundled = language.gram_vectors(language.trigrams(["abab", "dcd"][row.doc_id]), language.DIMENSIONS).astype(float).sum(axis=0)
        cosines = {lang: bundled @ v / np.linalg.norm(bundled) / np.linalg.norm(v) for lang, v in prototypes}
        assert row.lang_pred == max(cosines, key=cosines.get) == "xy"[row.doc_id]
        assert abs(row.score - cosines[row.lang_pred]) < 1e-5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred != 'und'")
    assert found.count() > 20
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_odd_rows_no_languages_and_empty_table(odd):
    rows = language.identify(odd).collect()
    assert len(rows) == odd.count() and all(r.lang_pred == "und" for r in rows)
    assert language.identify(odd.where(F.lit(False))).count() == 0


def test_letters_beyond_the_latin_ones_have_vectors_of_their_own(documents):
    vectors = language.letter_vectors(np.arange(0xDF, 0x180), 512).astype(int)
    cosines = vectors @ vectors.T / 512 - np.eye(len(vectors))
    assert abs(cosines).max() < 0.3
    pairs = [("sä mäk täl", "sœ mœk tœl"), ("мир дом", "рим мод"), ("山水 火", "木水 火")]
    for one, other in pairs:
        docs = documents([(i, t, lang) for i, (t, lang) in enumerate([(one, "x"), (other, "y")] * 3)])
        prototypes = [(r.lang, list(r.vector)) for r in language.train(docs).collect()]
        found = language.predict(documents([one, other]), prototypes).orderBy("doc_id").collect()
        assert [r.lang_pred for r in found] == ["x", "y"] and min(r.score for r in found) > 0.99


def test_few_kept_vectors_change_no_bundle(monkeypatch):
    texts = ["der hund und die katze", "le chat et le chien", "火山", "aaa", "der hund"] * 3
    for known, part in [(4, 3), (16, 64), (1 << 14, 1 << 12)]:
        monkeypatch.setattr(language, "KNOWN_GRAMS", known)
        monkeypatch.setattr(language, "BUNDLED_GRAMS", part)
        bundled = language.Bundler(64)
        for text in texts:
            grams = language.trigrams(text)
            assert (bundled(*language._counts(grams)) == language.gram_vectors(grams, 64).astype(int).sum(axis=0)).all()


def test_counts_handed_on_early_change_no_prototype(documents, monkeypatch):
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate([("aba abab", "x"), ("cdc dcdc", "y"), ("äöü", "z")] * 3)])
    whole = {r.lang: r.vector for r in language.train(docs).collect()}
    monkeypatch.setattr(language, "TRAIN_GRAMS", 1)
    assert {r.lang: r.vector for r in language.train(docs).collect()} == whole
