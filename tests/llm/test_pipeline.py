from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.compare import connect, difference
from tests.llm.cases import components, documents, frame, prose, shingles
from tripflow.llm import registry

FOLDER = "/root/testdata/sf0.001"


def run_stages(spark, docs, stages):
    for _, work in stages:
        docs = work(spark, docs, FOLDER)
    return docs


def test_stages_keep_the_columns_of_documents(spark):
    docs = frame(spark)
    for _, work in corpus_pipeline.STAGES[:-1]:
        assert work(spark, docs, FOLDER).columns == docs.columns


def test_filtering_stages_match_brute_force(spark):
    rows = documents()
    left = {doc_id: text for doc_id, text, *_ in rows if doc_id is not None and any(map(str.isalpha, text or ""))}
    texts: dict = {}
    for doc_id, text in left.items():
        texts.setdefault("".join(text.split()), []).append((-len(text), doc_id))
    distinct = {min(group)[1]: left[min(group)[1]] for group in texts.values()}
    kept = set(components(list(distinct.items()), words=5, percent=80).values())
    found = run_stages(spark, frame(spark), corpus_pipeline.STAGES[:3]).collect()
    assert sorted(row["doc_id"] for row in found if row["doc_id"] is not None) == sorted(kept)
    assert sum(row["doc_id"] is None for row in found) == 1


def test_a_text_of_no_language_learned_goes(spark):
    texts = [prose(k, 60) for k in range(30)] + ["\u6f22\u5b57\u4eee\u540d" * 20, "\u6f22\u5b57", "ok", "1234 " * 20, None]
    docs = frame(spark, [(k, text, "en", "s1", 0) for k, text in enumerate(texts)])
    kept = sorted(row["doc_id"] for row in corpus_pipeline.language_stage(spark, docs, FOLDER).collect())
    assert kept == [*range(30), 31, 32]


def test_a_corpus_without_labels_is_kept(spark):
    docs = frame(spark, [(k, f"text number {k}" if k else " 12 ", None, "s1", 0) for k in range(20)])
    kept = corpus_pipeline.language_stage(spark, docs, FOLDER)
    assert kept.columns == docs.columns and sorted(row["doc_id"] for row in kept.collect()) == list(range(1, 20))


def five_word_likeness(one, other):
    ours, theirs = shingles(one, 5), shingles(other, 5)
    return len(ours & theirs) / len(ours | theirs)


def test_near_stage_links_at_five_words_and_four_fifths(spark):
    base = [f"w{k}" for k in range(200)]
    changed = lambda places: " ".join("new" + word if k in places else word for k, word in enumerate(base))
    texts = [" ".join(base), changed({40, 80, 120, 160}), changed({20, 50, 80, 110, 140, 170})]
    assert five_word_likeness(texts[0], texts[1]) > 0.8 > five_word_likeness(texts[0], texts[2])
    assert five_word_likeness(texts[1], texts[2]) < 0.8
    docs = frame(spark, [(k, text, "en", "s1", 0) for k, text in enumerate(texts)])
    assert sorted(row["doc_id"] for row in corpus_pipeline.near_stage(spark, docs, FOLDER).collect()) == [0, 2]


def test_run_encodes_every_copy_of_the_mix(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    per_doc = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ids").alias("versions")).collect()
    assert per_doc and all(row["n"] <= 3 and row["versions"] == 1 for row in per_doc)
    assert rows.filter("n_ids != size(ids) OR n_ids = 0").isEmpty()


def test_encoding_tells_texts_that_do_not_come_back(spark):
    texts = ["some words", "a \u2581 mark", None, "", "漢字 é"]
    docs = frame(spark, [(k, text, "en", "s1", 0) for k, text in enumerate(texts)])
    found = {row["doc_id"]: row["round_trip"] for row in corpus_pipeline.encoding_stage(spark, docs, FOLDER).collect()}
    assert found == {0: True, 1: False, 2: True, 3: True, 4: True}


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)
    assert {*registry.QUERIES, "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_match_their_sql(spark, name):
    assert difference(spark, connect(FOLDER), name, FOLDER) is None
