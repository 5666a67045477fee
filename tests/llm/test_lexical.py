from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LOWER, clashing, documents, frame, prose
from tripflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def brute(rows: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    held = [(key, Counter(terms_of(text))) for key, text in rows]
    held = [(key, own, sum(own.values())) for key, own in held if own]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, own, _ in held for term in own)
    found = []
    for item_id, text in items:
        scores = []
        for key, own, n in held:
            norm = 100 - 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1))) * ((10**9 * own[term]) // (1000 * own[term] + 20 * norm))
                for term in set(terms_of(text)) & own.keys()
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, missing, key) in enumerate(sorted(scores)[:top], 1):
            found.append((item_id, rank, None if missing else key, -score))
    return found


def sortable(rows: list[tuple]) -> list[str]:
    return sorted(map(repr, rows))


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_odd_documents_and_items(spark):
    rows = documents()
    texts = [row[1] for row in rows if row[1]]
    items = [(k, text) for k, text in enumerate([*texts[::5], None, "", " ,.", "nothing here zzz", "ONE a", "é 漢字"])]
    items += [(None, texts[9]), (0, texts[3])]
    docs = clashing(frame(spark)).withColumns({name: F.lit("x") for name in ("item", "rank", "terms", "times")})
    for top in (3, 50):
        found = lexical.best_documents(docs, items_frame(spark, items).withColumn("rank", F.lit(0)), top)
        assert sortable([tuple(row) for row in found.collect()]) == sortable(brute([row[:2] for row in rows], items, top))


def test_many_documents_in_small_trees(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    rows = [(k, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for k in range(3000)]
    rows += [(5000 + k, rows[7][1]) for k in range(200)]  # ties beyond the 50th
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(20)] + [(99, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = sortable(brute(rows, items, 50))
    for leaf, tree, block in ((64, 16_384, 1000), (4, 300, 1000), (16, 500, 8)):
        monkeypatch.setattr(lexical, "LEAF", leaf)
        monkeypatch.setattr(lexical, "TREE_DOCS", tree)
        monkeypatch.setattr(lexical, "ITEMS", block)
        found = lexical.best_documents(docs, items_frame(spark, items))
        assert sortable([tuple(row) for row in found.collect()]) == expected


def built(rng: random.Random, n: int):
    """Documents of four vocabularies, one item of each."""
    texts = [" ".join(f"v{k % 4}x{int(rng.paretovariate(0.6)) % 300}" for _ in range(40)) for k in range(n)]
    items = lexical.Items.of([" ".join(f"v{k}x{j}" for j in range(1, 200, 9)) for k in range(4)])
    starts, terms, times = [0], [], []
    for text in texts:
        own = Counter(items.numbers[t.encode()] for t in text.split() if t.encode() in items.numbers)
        terms += sorted(own)
        times += [own[t] for t in sorted(own)]
        starts.append(len(terms))
    terms, starts = np.array(terms), np.array(starts)
    df = np.bincount(terms, minlength=len(items.numbers))
    weights = lexical.Weights(np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64), n, 40 * n)
    values = weights.values(np.array(times), np.full(len(terms), 40))
    rows = lexical.Rows(np.arange(n), np.zeros(n, bool), starts, terms, values)
    return items, weights, rows.take(np.flatnonzero(np.diff(starts) > 0))


def test_bounds_hold_for_all_rows_below_and_searches_prune():
    items, weights, rows = built(random.Random(8), 2000)
    space = lexical.Space(items, weights)
    tree = lexical.ball_tree(rows, space)

    def below(node):
        if node.below is None:
            return [node.rows]
        leaves = [leaf for child in node.below for leaf in below(child)]
        for item in range(len(items)):
            own = items.terms[items.starts[item] : items.starts[item + 1]]
            dense = np.zeros(len(weights.terms), dtype=np.int64)
            dense[own] = weights.terms[own]
            assert max(leaf.dot(dense).max() for leaf in leaves) <= node.bounds[item]
        return leaves

    leaves = below(tree)
    assert sum(len(leaf.ids) for leaf in leaves) == len(rows.ids)
    for item in range(len(items)):
        own = items.terms[items.starts[item] : items.starts[item + 1]]
        dense = np.zeros(len(weights.terms), dtype=np.int64)
        dense[own] = weights.terms[own]
        best = lexical.Best(10)
        scored = lexical.search(tree, item, dense, best)
        assert scored < len(leaves) / 2
        scores = rows.dot(dense)
        order = np.lexsort((rows.ids, -scores))[:10]
        assert best.ids.tolist() == rows.ids[order].tolist() and best.scores.tolist() == scores[order].tolist()


def test_long_texts_in_pieces(monkeypatch):
    text = prose(6, 200) + "x" * 100
    whole = [term for part in lexical.terms_of(text) for term in part]
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert [term for part in lexical.terms_of(text) for term in part] == whole
    assert [term.decode() for term in whole] == terms_of(text)


@pytest.mark.parametrize("side", ["documents", "items"])
def test_empty_tables(spark, side):
    docs = frame(spark, [] if side == "documents" else None)
    items = items_frame(spark, [] if side == "items" else [(1, "one")])
    found = lexical.best_documents(docs, items)
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
