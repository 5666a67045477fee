from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import WORD, clashing, documents, frame
from tripflow.llm import line_dedup


def brute(rows: list[tuple], min_words: int) -> list[list[int]]:
    """Lines in any run of enough words that occurs at an earlier place."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    runs: dict = {}  # (number of a run, next line) -> number of the longer run, of all runs seen so far
    result: list = [None] * len(rows)
    for k in order:
        lines = (rows[k][1] or "").split("\n")
        counts = [len(WORD.findall(line)) for line in lines]
        gone: set = set()
        for a in range(len(lines)):
            run, words, end = 0, 0, a
            for b in range(a, len(lines)):
                words += counts[b]
                known = len(runs) + 1
                run = runs.setdefault((run, lines[b]), known)
                if run != known and words >= min_words:
                    end = b + 1
            gone.update(range(a, end))
        result[k] = sorted(gone)
    return result


def lines(seed: int, docs: int) -> list[tuple]:
    """Documents of few different lines, with runs that repeat within and across them."""
    rng = random.Random(seed)
    known = ["", "a", "b b", "c c c", "d d d d d", "e e e e e e e"]
    texts = []
    for k in range(docs):
        own = [rng.choice(known) if rng.random() < 0.8 else f"only {k} {rng.random()}" for _ in range(rng.randrange(14))]
        texts.append("\n".join(own))
    return [(k, text, None, None, 0) for k, text in enumerate(texts)]


def marked(docs, min_words):
    rows = line_dedup.mark_copied_lines(docs, min_words=min_words).select("row.doc_id", "row.text", "deleted").collect()
    return sorted(((row["doc_id"], row["text"], row["deleted"]) for row in rows), key=str)


@pytest.mark.parametrize(("seed", "min_words"), [(1, 5), (2, 8), (3, 12), (4, 1)])
def test_deleted_lines_match_brute_force(spark, seed, min_words):
    rows = lines(seed, 25)
    want = sorted(((*row[:2], gone) for row, gone in zip(rows, brute(rows, min_words), strict=True)), key=str)
    assert marked(clashing(frame(spark, rows)).repartition(3), min_words) == want
    assert any(gone for *_, gone in want)


def test_documents_of_all_kinds(spark):
    rows = marked(frame(spark), 50)
    want = [(*row[:2], gone) for row, gone in zip(documents(), brute(documents(), 50), strict=True)]
    assert sorted(str(row[2]) for row in rows) == sorted(str(row[2]) for row in want)
    assert len(rows) == len(documents())
    assert max(len(row[2]) for row in rows) > 1000  # a very long copy goes


def test_one_hash_does_not_make_lines_equal(spark, monkeypatch):
    hashes = line_dedup.line_hashes
    rows = lines(5, 25)
    want = sorted(((*row[:2], gone) for row, gone in zip(rows, brute(rows, 5), strict=True)), key=str)
    for weak in (0, 1):
        def worse(text, weak=weak):
            return tuple(
                F.lit(7).cast("long").alias(name) if place == weak else value
                for place, (name, value) in enumerate(zip(("hash", "other"), hashes(text), strict=True))
            )

        monkeypatch.setattr(line_dedup, "line_hashes", worse)
        assert marked(frame(spark, rows), 5) == want


def test_a_line_in_a_third_of_all_documents(spark):
    rows = [(k, "\n".join(["one two three"] * 3 + [f"own {k}"] if k % 3 == 0 else [f"a {k}", "b b b b b", f"c {k % 9}"]), None, None, 0)
            for k in range(900)]
    got = marked(frame(spark, rows).repartition(6), 9)
    want = sorted(((*row[:2], gone) for row, gone in zip(rows, brute(rows, 9), strict=True)), key=str)
    assert got == want and sum(bool(gone) for *_, gone in got) == 299


def test_remaining_text(spark):
    docs = spark.createDataFrame([("a\n\nb\nc", [1, 2]), ("a", [0]), (None, [])], "text string, gone array<int>")
    clean = docs.select(line_dedup.remaining(F.col("text"), F.col("gone")).alias("clean")).collect()
    assert [row["clean"] for row in clean] == ["a\nc", "", ""]


def test_ranks_are_in_the_order_of_the_runs(spark):
    text = "\n".join(random.Random(2).choices("xyz", k=40))
    rows = line_dedup.placed_rows(frame(spark, [(1, text, None, None, 0)]), "doc_id")
    table = line_dedup.repeated_stretches(rows, "text", 1)
    order = {row["i"]: row["line"] for row in table.collect()}
    for level in (1, 2):
        ranks = {row["i"]: row["rank"] for row in line_dedup.suffix_ranks(table, 4).filter(f"level = {level}").collect()}
        runs = {i: [order[k] for k in range(i, i + (1 << level))] for i in ranks}
        for i in ranks:
            for j in ranks:
                assert (ranks[i] < ranks[j]) == (runs[i] < runs[j])


def test_empty_table_and_native_plan(spark):
    assert line_dedup.mark_copied_lines(frame(spark, [])).count() == 0
    plan = line_dedup.mark_copied_lines(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_one_key_spread_over_tasks(spark):
    docs = frame(spark, [(None if k % 2 else 7, f"text {k}", None, None, 0) for k in range(4000)]).repartition(4)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # or AQE makes one task of so few rows
    try:
        rows = line_dedup.placed_rows(docs, "doc_id").selectExpr("row.doc_id", "at", "at >> 33 AS part").collect()
    finally:
        spark.conf.unset(merging)
    assert len({row["at"] for row in rows}) == 4000
    assert max(row["at"] for row in rows if row["doc_id"] == 7) < min(row["at"] for row in rows if row["doc_id"] is None)
    sizes = [sum(row["part"] == part for row in rows) for part in {row["part"] for row in rows}]
    assert len(sizes) >= 3 and max(sizes) < 2000
