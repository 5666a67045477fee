from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import clashing, documents, frame
from tripflow.llm import language


def test_sliced_filters_count_like_sets():
    rng = np.random.default_rng(5)
    typical = [rng.integers(0, 2**32, 3000, dtype=np.uint32) for _ in range(70)]
    model = language.Model.of([f"l{k:02d}" for k in range(70)], typical)
    text = b"  " + bytes(rng.integers(97, 123, 500, dtype=np.uint8)) + b"  "
    n, found = model.counts([text, text[:20]])
    assert n.tolist() == [len(text) - 3, 17] and found.shape == (2, 70)
    own = language.grams(np.frombuffer(text, dtype=np.uint8))
    model = language.Model.of(["a", "b"], [own, own[:1]])
    _, found = model.counts([text])
    assert found[0, 0] == len(own) and 1 <= found[0, 1] < 5


def test_long_texts_go_in_pieces(monkeypatch):
    model = language.Model.of(["a"], [language.grams(np.frombuffer(b"abcdefgh", dtype=np.uint8))])
    text = language.as_bytes("abcdefgh " * 50)
    whole = model.scores([text, language.as_bytes("x")])
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose(model.scores([text, language.as_bytes("x")]), whole)


def test_undecided_texts_and_clashing_columns(spark):
    docs = clashing(frame(spark))
    found = language.identify(docs, language.fit(frame(spark))).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    assert len(found) == len(documents())
    for row in found:
        letters = any(map(str.isalpha, row["text"] or ""))
        assert (row["lang_pred"] == "und") == (not letters)
        assert row["lang_pred"] in ("und", "en", "fr") and 0 <= row["score"] <= 1


def test_slots_follow_the_number_of_ngrams():
    rng = np.random.default_rng(6)
    codes = np.unique(rng.integers(0, 2**32, 300_000, dtype=np.uint32))
    model = language.Model.of(["a", "b"], [codes, codes[:5]])
    assert model.slot_bits == 23 and model.false_rate[0] < 0.01
    assert language.Model.of(["a"], [codes[:0]]).slot_bits == language.SLOT_BITS


def test_all_typical_ngrams_are_kept(spark):
    letters = np.random.default_rng(9).integers(97, 123, (30_000, 4), dtype=np.uint8)
    texts = [" ".join(word.tobytes().decode() for word in letters)] * 3
    model = language.fit(frame(spark, [(k, text, "en", None, 0) for k, text in enumerate(texts)]))
    own = np.unique(language.grams(np.frombuffer(language.as_bytes(texts[0]), dtype=np.uint8)))
    bits = model.sliced[0]
    assert len(own) > 50_000
    assert all((bits[language.slots(own, multiplier, model.slot_bits)] == 1).all() for multiplier in language.HASHES)


def test_nothing_to_learn_from(spark):
    model = language.fit(frame(spark, []))
    assert {row["lang_pred"] for row in language.identify(frame(spark), model).collect()} == {"und"}
    assert language.identify(frame(spark, []), model).count() == 0


def test_held_out_rows_teach_nothing(spark):
    rows = spark.range(30).select(language.held_out(F.col("id")).alias("out"), "id").collect()
    assert all(row["out"] == (zlib.crc32(str(row["id"]).encode()) % 3 == 1) for row in rows)
    held = [row["id"] for row in rows if row["out"]]
    docs = frame(spark, [(k, "un texte", "xx" if k in held else "fr", None, 0) for k in range(30)])
    assert language.fit_unheld(docs).languages == ["fr"]


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = language.op9_language_id(spark, folder).filter("held_out")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right, n = found.join(docs, "doc_id").agg(F.avg(F.expr("cast(lang = lang_pred AS int)")), F.count(F.lit(1))).first()
    assert n > 250 and right > 0.98
