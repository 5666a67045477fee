from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LOWER, WORD, clashing, documents, frame, prose
from tripflow.llm import suffix_tree


def words_of(text: str | None) -> list[str]:
    return [*WORD.findall((text or "").translate(LOWER)), "END"]


class Brute:
    """The tree of the docstring with dictionaries of tuples."""

    def __init__(self, texts: list[str | None], depth: int, p_min: float) -> None:
        self.grams = [Counter() for _ in range(depth + 1)]
        for text in texts:
            own = words_of(text)
            for k, grams in enumerate(self.grams):
                grams.update(tuple(own[at : at + k + 1]) for at in range(len(own) - k))
        self.counts, self.depth = self.grams[0], depth
        self.tokens, self.vocabulary = sum(self.counts.values()), len(self.counts)
        threshold = max(2, math.ceil(p_min * self.tokens))
        self.common = [{run: n for run, n in grams.items() if n >= threshold} for grams in self.grams]
        self.after = {}
        for runs in self.common[1:]:
            for run, n in runs.items():
                self.after.setdefault(run[:-1], {})[run[-1]] = n
        self.states = set()
        for context, stored in self.after.items():
            n = self.count(context)
            p = {word: own / n for word, own in stored.items()}
            q = {word: self.count((*context[1:], word)) / self.count(context[1:]) for word in stored}
            rest = [max(0.0, 1 - sum(each.values())) + 1e-12 for each in (p, q)]
            gain = sum(p[w] * math.log(p[w] / q[w]) for w in p) + (rest[0] - 1e-12) * math.log(rest[0] / rest[1])
            if n * gain >= 0.5 * math.log(self.tokens) * len(stored):
                self.states |= {context[k:] for k in range(len(context))}

    def count(self, run: tuple) -> int:
        return self.grams[len(run) - 1][run] if run else self.tokens

    def p(self, context: tuple, word: str) -> float:
        value = (self.counts[(word,)] + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1))
        for k in range(1, min(self.depth, len(context)) + 1):
            state = context[-k:]
            if state in self.states:
                n, stored = self.count(state), self.after[state]
                rest = 1 - sum(own - suffix_tree.DISCOUNT for own in stored.values()) / n
                value = (stored[word] - suffix_tree.DISCOUNT if word in stored else 0) / n + rest * value
        return value

    def scores(self, text: str | None) -> tuple[int, int, float, float]:
        own = words_of(text)
        known = sum(self.counts[(word,)] > 0 for word in own)
        base = sum(math.log10(self.p((), word)) for word in own)
        return len(own), known, base, sum(math.log10(self.p(tuple(own[:at]), word)) for at, word in enumerate(own))


@pytest.mark.parametrize("depth, p_min", [(3, 1e-6), (2, 1e-3), (1, 3e-4), (1, 0.5)])
def test_equals_brute_force(spark, depth, p_min):
    rows = documents()
    train = [row[1] for row in rows if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 10]
    docs = clashing(frame(spark)).withColumns({name: F.lit("x") for name in ("rare", "times", "key", "more", "gain")})
    model, words = suffix_tree.fit(docs.filter(~suffix_tree.held_out(F.col("doc_id"))), depth=depth, p_min=p_min)
    brute = Brute(train, depth, p_min)
    assert (model.tokens, model.vocabulary) == (brute.tokens, brute.vocabulary)
    found = sorted(
        (row["id"] is None, row["id"] or 0, row["n_tokens"], row["n_known"], round(row["base_score"], 6), round(row["score"], 6))
        for row in suffix_tree.score(docs, model, words).collect()
    )
    expected = []
    for row in rows:
        n, known, base, score = brute.scores(row[1])
        expected.append((row[0] is None, row[0] or 0, n, known, round(base, 6), round(score, 6)))
    assert [row[:4] for row in found] == [row[:4] for row in sorted(expected)]
    assert np.allclose([row[4:] for row in found], [row[4:] for row in sorted(expected)], rtol=1e-9)
    assert (p_min == 0.5 or any(map(np.any, model.states))) and len(brute.states) == sum(int(each.sum()) for each in model.states)


@pytest.mark.parametrize("p_min, bucket, depth", [(2e-3, 10**6, 3), (2e-3, 1500, 3), (1e-6, 200, 3), (1.0, 3000, 2)])
def test_whole_tree_equals_brute_force(spark, monkeypatch, p_min, bucket, depth):
    """Runs of two occurrences are contexts where P_MIN is more than that, and where contexts lie in several tasks."""
    monkeypatch.setattr(suffix_tree, "P_MIN", p_min)
    monkeypatch.setattr(suffix_tree, "BUCKET", bucket)
    monkeypatch.setattr(suffix_tree, "CHUNK", 4000)
    rows = documents()
    docs = clashing(frame(spark)).withColumns({name: F.lit("x") for name in ("learns", "codes", "chunk", "lengths", "kind")})
    scores, learned = suffix_tree.tree_scores(docs, ~suffix_tree.held_out(F.col("doc_id")), depth=depth)
    brute = Brute([row[1] for row in rows if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 10], depth, 0.0)
    assert learned == brute.tokens
    order = lambda row: (row[0] is None, row[0] or 0, *row[1:])
    found, expected = sorted(map(tuple, scores.collect()), key=order), sorted(((row[0], *brute.scores(row[1])) for row in rows), key=order)
    assert [row[:3] for row in found] == [row[:3] for row in expected]
    assert np.allclose([row[3:] for row in found], [row[3:] for row in expected], rtol=1e-9)


@pytest.mark.parametrize("head, p_min, bucket, depth", [(10**6, 1e-6, 200, 3), (20, 2e-3, 200, 3), (60, 1e-6, 1500, 2), (0, 1e-6, 400, 3)])
def test_head_of_any_size_and_sums_of_few_rows(spark, monkeypatch, head, p_min, bucket, depth):
    """Scores don't depend on how many words every task knows, or on parts; what a pass leaves is a row per chunk."""
    for name, value in (("HEAD", head), ("P_MIN", p_min), ("BUCKET", bucket), ("CHUNK", 4000)):
        monkeypatch.setattr(suffix_tree, name, value)
    left = {}

    def stage(df, label, kept=suffix_tree.stage):
        found = kept(df, label)
        left.setdefault(label, []).append(found.count())
        return found

    monkeypatch.setattr(suffix_tree, "stage", stage)
    rows = documents()
    scores, _ = suffix_tree.tree_scores(frame(spark), ~suffix_tree.held_out(F.col("doc_id")), depth=depth)
    brute = Brute([row[1] for row in rows if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 10], depth, 0.0)
    order = lambda row: (row[0] is None, row[0] or 0, *row[1:])
    found, expected = sorted(map(tuple, scores.collect()), key=order), sorted(((row[0], *brute.scores(row[1])) for row in rows), key=order)
    assert [row[:3] for row in found] == [row[:3] for row in expected]
    assert np.allclose([row[3:] for row in found], [row[3:] for row in expected], rtol=1e-9)
    assert len(left["suffix-sums"]) == suffix_tree.PASSES and max(left["suffix-sums"]) <= left["suffix-chunks"][0]


def test_frequent_words_have_small_codes():
    words = suffix_tree.Runs(np.array([5, 9, 2**63 + 7, 2**64 - 1], dtype=np.uint64), np.array([3, 8, 4, 9]))
    head, counts = suffix_tree.Head.ranked(words)
    assert counts.tolist() == [9, 8, 4, 3]
    flat = np.array([9, 2**64 - 1, 6, 5, 2**63 + 7, 2**63 + 8], dtype=np.uint64)
    assert head.of(flat).tolist() == [2, 1, 2**63 + 6, 4, 3, 2**63 + 8]
    empty, _ = suffix_tree.Head.ranked(suffix_tree.Runs(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)))
    assert empty.of(flat[:1]).tolist() == [2**63 + 9]


def test_whole_tree_without_rows_or_teachers(spark):
    scores, learned = suffix_tree.tree_scores(frame(spark), F.lit(False))
    assert learned == 0 and {(row["n_known"], row["base_score"], row["score"]) for row in scores.collect()} == {(0, 0.0, 0.0)}
    assert scores.count() == len(documents())
    scores, learned = suffix_tree.tree_scores(frame(spark, []), F.lit(True))
    assert learned == 0 and scores.count() == 0


def test_distributions_sum_to_one(spark):
    texts = [prose(k % 3, 60) for k in range(12)]
    model, _ = suffix_tree.fit(frame(spark, [(k, text, None, None, 0) for k, text in enumerate(texts)]), p_min=0.0)
    brute = Brute(texts, 3, 0.0)
    vocabulary = [word for (word,) in brute.counts]
    for context in list(brute.states)[:25]:
        total = sum(brute.p(context, word) for word in vocabulary) + brute.p(context, "never seen")
        assert total == pytest.approx(1)
    assert all(((0 < rest[state]) & (rest[state] <= 1)).all() for rest, state in zip(model.rest, model.states, strict=True))


def test_long_words_and_texts_in_pieces(monkeypatch):
    texts = ["a bb " * 50 + "x" * 40, "", "c", " y " * 30]
    whole = [(flat.tolist(), lengths.tolist()) for flat, lengths in suffix_tree.tokens(texts)]
    monkeypatch.setattr(suffix_tree, "PIECE", 16)
    cut = [(flat.tolist(), lengths.tolist()) for flat, lengths in suffix_tree.tokens(texts)]
    assert sum((flat for flat, _ in whole), []) == sum((flat for flat, _ in cut), [])
    assert sum((each for _, each in whole), []) == sum((each for _, each in cut), []) == [102, 1, 2, 31]


def test_counts_pass_on_when_many(spark, monkeypatch):
    docs = frame(spark)
    once = {row["key"]: row["n"] for row in suffix_tree.counted(docs.select(F.coalesce("text", F.lit("")).alias("text")), []).collect()}
    monkeypatch.setattr(suffix_tree, "HELD", 50)
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    assert {row["key"]: row["n"] for row in suffix_tree.counted(docs, []).collect()} == once


def test_no_training_rows_and_no_rows(spark):
    model, words = suffix_tree.fit(frame(spark, []))
    rows = suffix_tree.score(frame(spark), model, words).collect()
    assert len(rows) == len(documents()) and all(row["score"] == row["base_score"] == 0 and row["n_known"] == 0 for row in rows)
    assert suffix_tree.score(frame(spark, []), model, words).count() == 0


def test_whole_table_and_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    rows = suffix_tree.op12_lm_scores(spark, folder).collect()
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    train, counts = [key for key in docs if zlib.crc32(str(key).encode()) % 10], Counter()
    for key in train:
        counts.update(words_of(docs[key]))
    total, unit = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    assert len(rows) == len(docs)
    for row in rows:
        own = words_of(docs[row["doc_id"]])
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 10 == 0) and row["train_tokens"] == total
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(counts[word] > 0 for word in own))
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[word] + 0.1) / unit) for word in own), rel=1e-9)
    held = [row for row in rows if row["held_out"]]
    better = sum(row["score"] for row in held) - sum(row["base_score"] for row in held)
    assert better > 0.05 * sum(row["n_tokens"] for row in held)
