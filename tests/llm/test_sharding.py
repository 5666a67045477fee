from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from tests.llm.cases import clashing, documents, frame
from tripflow.llm import sharding


def test_hypergeometric_law():
    rng = np.random.default_rng(3)
    drawn = Counter(sharding.hypergeometric(5, 7, 4, rng) for _ in range(20_000))
    exact = {0: 35, 1: 175, 2: 210, 3: 70, 4: 5}  # of 495
    assert set(drawn) == set(exact)
    assert all(abs(drawn[k] / 20_000 - n / 495) < 0.015 for k, n in exact.items())
    assert sharding.hypergeometric(0, 5, 3, rng) == 0 and sharding.hypergeometric(5, 0, 3, rng) == 3
    large = [sharding.hypergeometric(10**12, 23 * 10**12, 10**11, rng) for _ in range(50)]
    assert abs(np.mean(large) - 10**11 / 24) < 1e5


def test_matrix_has_exact_margins():
    parts = [0, 7, 1, 100, 33, 0, 12]
    matrix = sharding.communication_matrix(parts, 24)
    assert matrix.sum(axis=1).tolist() == parts
    sizes = matrix.sum(axis=0)
    assert sizes.max() - sizes.min() <= 1 and (matrix >= 0).all()


def test_rows_slots_and_contents(spark):
    rows = sharding.shard_rows(clashing(frame(spark)).repartition(4), 5).select("row.doc_id", "row.text", "row.size", "shard", "slot").collect()
    assert Counter((row["doc_id"], row["text"]) for row in rows) == Counter((doc_id, text) for doc_id, text, *_ in documents())
    slots = {}
    for row in rows:
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_places_are_uniform(spark):
    docs = spark.range(4000, numPartitions=8)
    rows = sharding.shard_rows(docs, 4).select("row.id", "shard", "slot").collect()
    first = Counter(row["shard"] for row in rows if row["id"] < 1000)
    assert all(abs(first[k] - 250) < 75 for k in range(4))
    slots = [row["slot"] for row in rows if row["id"] < 1000]
    assert abs(np.mean(slots) - 500) < 40


def test_few_rows_and_none(spark):
    assert sharding.shard_rows(frame(spark, [])).count() == 0
    rows = sharding.shard_rows(frame(spark, documents()[:3])).select("shard", "slot").collect()
    assert sorted(tuple(row) for row in rows) == [(0, 0), (1, 0), (2, 0)]


def test_query_sizes_and_checksums(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.op8_sharding(spark, str(tmp_path)).collect()
    want = Counter((doc_id, len((text or "").encode()) + 8, zlib.crc32((text or "").encode())) for doc_id, text, *_ in documents())
    assert Counter((row["doc_id"], row["size"], row["text_crc32"]) for row in rows) == want


def test_other_rows_than_were_counted_mean_another_attempt(spark, monkeypatch):
    planned, calls = sharding.running_sums, []

    def wrong_once(parts):
        calls.append(parts)
        return planned([parts[0] + 1, *parts[1:]] if len(calls) == 1 else parts)

    monkeypatch.setattr(sharding, "running_sums", wrong_once)
    assert sharding.shard_rows(frame(spark), 3).count() == len(documents()) and len(calls) == 2


def test_a_task_finds_its_row_without_the_others():
    """Of many partitions a row takes few draws, and all rows together keep both margins."""
    rng = np.random.default_rng(4)
    parts = rng.integers(0, 50, 500).tolist()
    ends = np.cumsum(parts).tolist()
    matrix = np.array([sharding.row_of(ends, part, 24, 3) for part in range(len(parts))])
    assert matrix.sum(axis=1).tolist() == parts
    assert set(matrix.sum(axis=0)) <= {sum(parts) // 24, sum(parts) // 24 + 1}
    drawn = []
    original = sharding.hypergeometric
    sharding.hypergeometric = lambda *given: drawn.append(1) or original(*given)
    try:
        sharding.row_of(list(range(100, 40_000_100, 100)), 123_456, 24)
    finally:
        sharding.hypergeometric = original
    assert len(drawn) <= 24 * 19
