from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tests.llm.cases import clashing, documents, frame, prose
from tripflow.llm import fingerprints


def brute_anchors(hashes: list[int]) -> list[int]:
    """Places of closed syncmers, given the hashes of the inner substrings."""
    w = fingerprints.W
    return [i for i in range(len(hashes) - w + 1) if min(hashes[i : i + w]) in (hashes[i], hashes[i + w - 1])]


def test_anchors_are_closed_syncmers(spark):
    rows = spark.createDataFrame([(prose(7, 40),), ("a a a a a a a",), ("one",)], "text string")
    words = fingerprints.word_hashes(F.col("text"))
    inner = fingerprints.neighbours(words, fingerprints.S - 1, lambda a, b: F.xxhash64(a, b))
    found = fingerprints.with_fingerprint(rows, F.col("text"), "f", 10_000)
    for row, own in zip(found.select("f").collect(), rows.select(inner.alias("s")).collect(), strict=True):
        places = brute_anchors(own["s"])
        assert set(row["f"]["position"]) <= set(places)
        assert len(row["f"]["position"]) == len(set(row["f"]["hash"]))


def test_anchors_do_not_depend_on_what_is_around(spark):
    middle = prose(8, 60).replace("\n", " ")
    rows = spark.createDataFrame([(0, middle), (1, f"{prose(9, 11)} {middle} {prose(10, 5)}")], "k int, text string")
    found = fingerprints.with_fingerprint(rows, F.col("text"), "f", 10_000).orderBy("k").collect()
    inside, around = (dict(zip(row["f"]["hash"], row["f"]["position"], strict=True)) for row in found)
    kept = [h for h, at in inside.items() if 4 <= at <= 50]
    assert kept and all(h in around for h in kept)
    pair = spark.createDataFrame([(found[0]["f"], found[1]["f"])], found_schema(found)).select(fingerprints.matches(F.col("a"), F.col("b")).alias("m"))
    offsets = [match["other"] - match["position"] for match in pair.first()["m"]]
    assert max(set(offsets), key=offsets.count) == 11


def test_all_anchors_of_a_long_text_are_kept(spark):
    rows = spark.createDataFrame([(prose(21, 3000),), (prose(22, 150) * 3,)], "text string")
    inner = fingerprints.neighbours(fingerprints.word_hashes(F.col("text")), fingerprints.S - 1, lambda a, b: F.xxhash64(a, b))
    found = fingerprints.with_fingerprint(rows.withColumn("s", inner), F.col("text"), "f")
    for row in found.select("f", "s").collect():
        assert row["f"]["position"] == brute_anchors(row["s"])
        assert len(row["f"]["hash"]) == len(row["f"]["position"])


def test_a_shared_passage_shows_in_long_texts(spark, tmp_path):
    passage = prose(30, 200)
    texts = [f"{prose(31, 9000)} {passage} {prose(32, 9000)}", f"{prose(33, 6000)} {passage} {prose(34, 12000)}"]
    rows = [(k, text, None, None, 0) for k, text in enumerate(texts)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = fingerprints.op5_fingerprints(spark, str(tmp_path)).collect()
    for row in found:
        anchors = len(row["fingerprint"].split())
        assert anchors > 5000
        assert 60 < row["near_next"] * 2 * anchors < 140
        # A third is replaced, so half of all different anchors are shared.
        assert abs(row["near_edited"] - 0.5) < 0.02


def test_an_anchor_elsewhere_is_not_shared(spark):
    kind = "struct<hash: array<int>, position: array<int>>"
    rows = [(([1, 2, 3], [0, 2, 3]), ([1, 2, 3], [7, 9, 10])), (([1, 2, 3], [0, 2, 3]), ([1, 2, 3], [0, 5, 9]))]
    pairs = spark.createDataFrame(rows, f"a {kind}, b {kind}")
    like = fingerprints.likeness(fingerprints.links(F.col("a")), fingerprints.links(F.col("b")))
    assert [row["l"] for row in pairs.select(like.alias("l")).collect()] == [1.0, 0.2]


def found_schema(_):
    kind = "struct<hash: array<int>, position: array<int>>"
    return f"a {kind}, b {kind}"


def test_query_values(spark, tmp_path):
    rows = [row for row in {row[0]: row for row in documents() if row[0] is not None}.values()]
    clashing(frame(spark, rows)).write.parquet(str(tmp_path / "documents.parquet"))
    found = {row["doc_id"]: row for row in fingerprints.op5_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(((row[0], row[1] or "") for row in rows), reverse=True)
    prints = {}
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert text != following or row["near_next"] == 1
    assert all(found[k]["near_edited"] > 0.3 for k in (9, 10, 11))


def test_many_buckets_give_the_same_neighbours(spark):
    docs = frame(spark)
    pairs = lambda size: sorted(str(row) for row in fingerprints.with_next(docs, "doc_id", "text", size).select("row.doc_id", "text", "next").collect())
    assert pairs(3) == pairs(10_000)


def test_equal_and_null_keys_spread_over_buckets(spark):
    keys = [None] * 200 + [7] * 200 + list(range(200))
    rows = [(key, f"text {k}", None, None, 0) for k, key in enumerate(keys)]
    docs = frame(spark, rows)
    held, heads = fingerprints.dealt(docs, "doc_id", "text", 20)
    sizes = [row["count"] for row in held.groupBy("bucket").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 60 and heads.count() == len(sizes)
    pairs = lambda size: sorted(str(row) for row in fingerprints.with_next(docs, "doc_id", "text", size).select("text", "next").collect())
    assert pairs(20) == pairs(10_000)


def test_the_plan_does_not_grow_with_the_buckets(spark):
    docs = frame(spark, [(k, f"text {k}", None, None, 0) for k in range(3000)])
    lengths = [len(fingerprints.with_next(docs, "doc_id", "text", size)._jdf.queryExecution().optimizedPlan().toString()) for size in (1, 3000)]
    assert abs(lengths[0] - lengths[1]) < 200


def test_one_row_and_none(spark):
    assert fingerprints.fingerprints(frame(spark, [])).count() == 0
    row = fingerprints.with_next(frame(spark, [(1, "abc", None, None, 0)]), "doc_id", "text").first()
    assert row["next"] == "abc"


def test_main_path_has_no_python(spark):
    plan = fingerprints.fingerprints(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
