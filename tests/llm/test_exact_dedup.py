from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.cases import clashing, documents, frame
from tripflow.llm import exact_dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def test_groups_and_winners(spark):
    rows = exact_dedup.mark_duplicates(clashing(frame(spark))).select("row.doc_id", "row.text", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert len(rows) == len(documents())
    groups = {}
    for doc_id, text, *_ in documents():
        groups.setdefault(normal(text), []).append((-len(text or ""), doc_id is None, doc_id))
    for row in rows:
        group = groups[normal(row["text"])]
        assert row["group_size"] == len(group)
        assert row["keep_id"] == min(group)[2]
        assert row["text_sha256"] == hashlib.sha256(normal(row["text"]).encode()).hexdigest()
    assert sum(row["kept"] for row in rows) == len(groups)


def test_kept_rows_have_the_columns_of_the_input(spark):
    docs = clashing(frame(spark))
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({normal(text) for _, text, *_ in documents()})


def test_equal_digests_of_different_texts_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("same"))
    rows = exact_dedup.mark_duplicates(frame(spark)).collect()
    assert sum(row["kept"] for row in rows) == len({normal(text) for _, text, *_ in documents()})


def test_empty_table(spark):
    assert exact_dedup.mark_duplicates(frame(spark, [])).count() == 0


def test_main_path_has_no_python(spark):
    plan = exact_dedup.mark_duplicates(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
