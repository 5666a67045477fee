from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from tests.llm.cases import WORD, clashing, documents, frame
from tripflow.llm import mixing


def brute_targets(sizes: dict, cap: int = 3) -> dict:
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weights = {name: k % 3 + 1 for k, name in enumerate(names)}
    targets, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[name] for name in full)
        free = [name for name in names if name not in full]
        share = {name: left * weights[name] / sum(weights[each] for each in free) for name in free}
        over = {name for name in free if share[name] > cap * sizes[name]}
        targets = {name: cap * sizes[name] for name in full} | share
        if not over:
            return targets
        full |= over


def brute_multiplier(cells: list[tuple[int, int]], target: float, cap: int = 3) -> float:
    """By bisection alone."""
    mean = sum(size * n for size, n in cells) / sum(n for _, n in cells)
    taken = lambda m: sum(n * size * min(cap, math.exp(min(50, m * (size / mean) / (1 + size / mean)))) for size, n in cells)
    low, high = -1e4, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if taken(middle) < target else (low, middle)
    return low


def sizes_by_source(rows):
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    return sizes


def test_targets_and_taken_words(spark):
    rows = mixing.mix(clashing(frame(spark)), mixing.words(F.col("text"))).select("row.doc_id", "row.text", "row.source", F.col("size").alias("words"), "source_size", "target", F.col("copies").alias("times")).collect()
    assert len(rows) == len(documents())
    sizes, targets, taken = sizes_by_source(documents()), brute_targets(sizes_by_source(documents())), {}
    for row in rows:
        assert row["words"] == len(WORD.findall(row["text"] or ""))
        assert row["source_size"] == sizes[row["source"]]
        assert math.isclose(row["target"], targets[row["source"]], rel_tol=1e-9)
        assert 0 <= row["times"] <= 3
        taken[row["source"]] = taken.get(row["source"], 0) + row["times"] * row["words"]
    for source, words in taken.items():
        largest = max(len(WORD.findall(text or "")) for _, text, _, own, _ in documents() if own == source)
        assert abs(words - targets[source]) <= largest


def test_full_sources_are_reshared():
    sizes = {"a": 10, "b": 1, "c": 1, None: 1}
    targets = brute_targets(sizes)
    assert targets["b"] == targets["c"] == targets[None] == 3 and math.isclose(targets["a"], 4)


def test_targets_match_resharing(spark):
    for sizes in ({"a": 10, "b": 1, "c": 1, None: 1}, {"s2": 5, "s10": 500, "ä": 7, "z": 90}, {"x": 0}, {"x": 7}):
        totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {row["source"]: row["target"] for row in mixing.source_targets(totals).collect()}
        assert all(math.isclose(found[name], value, abs_tol=1e-9) for name, value in brute_targets(sizes).items())


def test_newton_finds_the_root(spark):
    cells = [("a", 5, 40), ("a", 200, 6), ("a", 9000, 1), ("b", 3, 10), ("b", 70, 4)]
    table = spark.createDataFrame(cells, "source string, size long, n long")
    targets = spark.createDataFrame([("a", 10400, 4000.0), ("b", 310, 600.0)], "source string, source_size long, target double")
    for row in mixing.solve_multipliers(table, targets).collect():
        own = [(size, n) for source, size, n in cells if source == row["source"]]
        assert math.isclose(row["multiplier"], brute_multiplier(own, row["target"]), rel_tol=1e-4)


def test_rounding_carries_its_error():
    cells = pd.DataFrame({"source": "a", "size": [1000, 100, 1], "n": [3, 50, 100], "rate": [0.5, 0.5, 0.5]})
    taken = mixing.whole_copies(cells)
    assert abs((taken["size"] * taken["copies"]).sum() - 0.5 * 8100) <= 1


def test_reruns_agree_and_mixed_documents_repeat(spark):
    docs = frame(spark)
    runs = [sorted(str(row) for row in mixing.mixed_documents(docs).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and runs[0]
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_empty_table_and_tables_without_words(spark):
    assert mixing.mix(frame(spark, []), F.lit(1)).count() == 0
    rows = mixing.mix(frame(spark, [(1, None, None, "a", 0), (2, " ", None, None, 0)]), F.lit(0)).collect()
    assert [row["copies"] for row in rows] == [1, 1]
