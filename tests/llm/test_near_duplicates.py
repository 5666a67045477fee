from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.cases import clashing, components, documents, frame, prose, shingles
from tripflow.llm import near_duplicates as near
from tripflow.llm.components import connected_components


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed: int, copies: int) -> list[tuple]:
    """Copies of one text with up to a dozen edits each, links and near misses between them."""
    rng = random.Random(seed)
    base = prose(seed, 160).split()
    texts = [edited(rng, base, rng.randrange(13)) for _ in range(copies)]
    chain, grown = prose(seed + 1, 100).split(), []
    for k in range(8):  # each links with the next, the first and the last do not
        chain = [*chain[3:], *prose(seed + 50 + k, 3).split()]
        grown.append(" ".join(chain))
    return [(k, text, None, None, 0) for k, text in enumerate([*texts, *grown])]


def found(spark, rows):
    return {row["id"]: row for row in near.link_components(frame(spark, rows)).collect()}


def test_words_and_sets_match_the_contract():
    texts = ["", " \t", "One", "one TWO", "a b c d a b c", "É é\x0bX\x0c\n y", prose(1, 50), "x" * 3000]
    sets = near.shingle_sets(texts)
    assert [len(own) for own in sets] == [len(shingles(text)) for text in texts]
    assert (near.shingle_sets(["one  TWO"])[0] == near.shingle_sets(["ONE\ttwo"])[0]).all()
    assert (near.shingle_sets(["É"])[0] != near.shingle_sets(["é"])[0]).all()
    assert all((a == b).all() for a, b in zip(near.shingle_sets(texts), [near.shingle_sets([t])[0] for t in texts], strict=True))


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("hot", [2048, 7])
def test_components_match_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(near, "HOT", hot)
    rows = near_copies(seed, 60)
    want = components([row[:2] for row in rows])
    got = found(spark, rows)
    assert {key: row["component"] for key, row in got.items()} == want
    assert 1 < len(set(want.values())) < len(rows)
    assert all(row["n"] == len(shingles(rows[key][1])) for key, row in got.items())


def test_documents_of_all_kinds(spark):
    rows = near.link_components(clashing(frame(spark))).collect()
    assert len(rows) == len(documents())
    want = components([row[:2] for row in documents() if row[0] is not None])
    for row in rows:
        assert row["component"] == (want[row["id"]] if row["id"] is not None else None)


def test_one_document_of_each_component_stays(spark):
    docs = clashing(frame(spark, near_copies(13, 40)))
    want = components([row[:2] for row in near_copies(13, 40)])
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(set(want.values()))


def test_rows_without_an_id_and_with_one_id_are_told_apart(spark):
    one, two = prose(61, 300), prose(62, 300)
    rows = [(None, one), (None, one + " a"), (5, one + " b"), (7, two), (7, two + " a"), (None, prose(63, 50)), (None, "")]
    docs = frame(spark, [(key, text, None, None, 0) for key, text in rows])
    kept = near.drop_near_duplicates(docs).collect()
    assert sorted(str(row["doc_id"]) for row in kept) == ["5", "7", "None", "None"]
    assert {row["text"] for row in kept if row["doc_id"] is None} == {rows[5][1], ""}


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for size in (3, 300, 5000):
        one = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        two = np.concatenate([one[: size // 2], rng.integers(0, 2**63, size // 3, dtype=np.uint64)])
        bits = [np.frombuffer(near.parity_sketch(own), np.uint64) for own in (one, two)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(one, two))


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(259, 300), (3, 3)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    labels = {row["node"]: row["component"] for row in rows}
    assert {labels[k] for k in range(100, 161)} == {100}
    assert {labels[k] for k in (7, 200, 259, 300)} == {7} and labels[3] == 3


def test_empty_tables(spark):
    assert near.link_components(frame(spark, [])).count() == 0
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    rows = near.link_components(frame(spark, [(1, None, None, None, 0), (2, "", None, None, 0)])).collect()
    assert sorted((row["id"], row["n"], row["component"]) for row in rows) == [(1, 0, 1), (2, 0, 2)]


def test_a_group_of_near_copies_costs_in_proportion(spark):
    """Rows dealt by n-gram, pairs met first and rows left for all pairs, of twice as many copies of one text."""
    costs = []
    for copies in (400, 800):
        rng, base = random.Random(5), prose(71, 200).split()
        rows = [(k, edited(rng, base, 1), None, None, 0) for k in range(copies)]
        named = frame(spark, rows).selectExpr("doc_id AS id", "text")
        stage = near.Stages(spark)
        described = near.described(named, 3, stage).filter("bucket IS NULL")
        sketches = described.select("class", "sketch").dropDuplicates(["class"])
        shared = near.shared_rows(near.prefix_rows(named, np.zeros(near.BUCKETS, dtype=np.int64), 3, 90), 90)
        first = near.near_by_sketch(near.first_pairs(shared, 90), sketches)
        linked = connected_components(first)
        assert linked.select("component").distinct().count() == 1
        assert near.open_rows(shared, linked, sketches).count() == 0
        costs.append((shared.count(), first.count()))
        stage.drop()
    assert all(twice < 2.3 * once for once, twice in zip(*costs, strict=True))
