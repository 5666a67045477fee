r"""Ranked lexical search: exact best documents by integer term weights, through sparse ball trees.

A document's score is the inner product of its term values with the weights of an item's terms. One pass
over the texts keeps what the items can ask for: of each document its length and how often it
holds each of their terms. Counts over all documents give weights and values. Every task then puts its documents,
some thousand at a time, into a ball tree and searches it for all items:

- Space has one axis per term of the items, stretched by the root of the term's weight. The axes fall
  into groups: terms of one item alone, by item, and shared terms by the first item that has them. A node
  has a centroid, and in every group a radius around it that reaches all documents below.
- In a group no document exceeds item . centroid + |item| * radius; their sum bounds the score. Bounds are
  rounded up: radii get a margin for the error of their squares, sums a relative one and a point more.
- The node with the highest bound comes next, and a search ends when that bound is below the item's
  ``top``-th score so far. In leaves scores are exact 64-bit integers. An equal bound is followed, for the smaller id wins.

Tasks hand on ``top`` rows an item, which are ranked in two steps.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.text import bounded_batches, table, whole
from tripflow.session import stage

TOP = 50
ITEMS = 1_000  # searched in one pass
TREE_DOCS, TREE_ENTRIES = 16_384, 2_000_000
LEAF = 64
PIECE = 1 << 20
SALTS = 64

# Letters, digits and all that is not ASCII make terms; in UTF-8 these are bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a long one in parts that end between terms."""
    data, at = text.encode(errors="surrogatepass").translate(LOWER), 0
    while at < len(data):
        cut = BREAK.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = cut.end() if cut else len(data)
        yield TERM.findall(data, at, end)
        at = end


@dataclass(frozen=True)
class Items:
    """Distinct terms of a block of items as numbers; ``starts`` cuts ``terms`` by item."""

    numbers: dict[bytes, int]
    starts: np.ndarray
    terms: np.ndarray
    groups: np.ndarray  # of each term, in rising order

    @staticmethod
    def of(texts: list[str]) -> Items:
        own = [sorted({term for part in terms_of(text) for term in part}) for text in texts]
        holders: dict[bytes, list[int]] = {}
        for item, terms in enumerate(own):
            for term in terms:
                holders.setdefault(term, []).append(item)
        group = {term: 2 * items[0] + (len(items) > 1) for term, items in holders.items()}
        numbers = {term: k for k, term in enumerate(sorted(group, key=lambda term: (group[term], term)))}
        _, groups = np.unique(np.array([group[term] for term in numbers], dtype=np.int64), return_inverse=True)
        lists = [np.array(sorted(numbers[term] for term in terms), dtype=np.int64) for terms in own]
        starts = np.cumsum([0, *map(len, lists)])
        return Items(numbers, starts, np.concatenate([*lists, np.zeros(0, dtype=np.int64)]), groups)

    def __len__(self) -> int:
        return len(self.starts) - 1


def matched(docs: DataFrame, items: Items) -> DataFrame:
    """``id``, ``n`` (terms with repeats), ``terms`` and ``times`` of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(items.numbers)  # the terms of at most ITEMS items

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for batch in batches:
            ids, lengths, starts, terms, times = [], [], [0], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, held = 0, Counter()
                for part in terms_of(text):
                    n += len(part)
                    held.update(filter(numbers.__contains__, part))
                if n:
                    found = sorted((numbers[term], k) for term, k in held.items())
                    ids.append(key)
                    lengths.append(n)
                    terms += [term for term, _ in found]
                    times += [k for _, k in found]
                    starts.append(len(terms))
            cuts = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))]
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "times"])

    return stage(docs.mapInArrow(made, "id long, n long, terms array<int>, times array<long>"), "lexical-matched")


@dataclass(frozen=True)
class Weights:
    """Integer weight of every term, and the sums over all documents that values depend on."""

    terms: np.ndarray
    documents: int
    length: int

    @staticmethod
    def of(rows: DataFrame, items: Items) -> Weights:
        total = rows.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        holders = np.zeros(len(items.numbers), dtype=np.int64)
        for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # terms of the items
            holders[row["term"]] = row["count"]
        n = total["documents"]
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * held + 1))) for held in holders.tolist()]
        return Weights(np.array(weights, dtype=np.int64), n, total["length"])

    def values(self, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        norm = 100 - 50 + (50 * lengths * self.documents) // max(self.length, 1)
        return (1_000_000_000 * times) // (1000 * times + 20 * norm)


@dataclass
class Rows:
    """Documents as sparse rows: entries ``starts[k]`` to ``starts[k + 1]`` belong to the k-th."""

    ids: np.ndarray
    missing: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, wanted: np.ndarray) -> Rows:
        lengths = np.diff(self.starts)[wanted]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        entries = np.arange(starts[-1]) + np.repeat(self.starts[:-1][wanted] - starts[:-1], lengths)
        return Rows(self.ids[wanted], self.missing[wanted], starts, self.terms[entries], self.values[entries])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(dense[self.terms] * self.values, self.starts[:-1])


class Space:
    """The items as vectors, and bounds of their products with all points of a node."""

    def __init__(self, items: Items, weights: Weights) -> None:
        self.items, self.weights = items, weights
        self.stretch = np.sqrt(np.maximum(weights.terms, 0).astype(float))
        self.groups = items.groups
        owner = np.repeat(np.arange(len(items)), np.diff(items.starts))
        key = owner * (len(self.groups) + 1) + self.groups[items.terms]
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
        self.part_starts = np.flatnonzero(first)
        self.part_group = self.groups[items.terms[self.part_starts]]
        squares = self.weights.terms[items.terms].astype(float)
        self.part_norm = np.sqrt(np.add.reduceat(squares, self.part_starts)) if len(key) else squares
        self.part_owner = owner[self.part_starts]

    def bounds(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Centroid of the rows, and for every item a number that no row's score exceeds."""
        count = len(rows.ids)
        stretched = rows.values * self.stretch[rows.terms]
        size = len(self.stretch)
        centroid = np.bincount(rows.terms, stretched, size) / count
        own = np.repeat(np.arange(count), np.diff(rows.starts))
        group = self.groups[rows.terms]
        cuts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (group[1:] != group[:-1])]))
        # |row - centroid|^2 is |centroid|^2 and, for the terms the row has, value^2 - 2 value centroid.
        apart = np.add.reduceat(stretched * (stretched - 2 * centroid[rows.terms]), cuts)
        most = np.zeros(self.groups[-1] + 1)
        np.maximum.at(most, group[cuts], apart)
        squared = np.bincount(self.groups, centroid**2, len(most))
        longest = np.zeros(len(most))
        np.maximum.at(longest, group[cuts], np.add.reduceat(stretched**2, cuts))
        radius = np.sqrt(np.maximum(most + squared, 0) + 1e-12 * (squared + longest))
        reach = np.bincount(self.part_owner, self.part_norm * radius[self.part_group], len(self.items))
        inner = self.stretch[self.items.terms] * centroid[self.items.terms]
        owner = np.repeat(np.arange(len(self.items)), np.diff(self.items.starts))
        product = np.bincount(owner, inner, len(self.items))
        return centroid, (product + reach) * (1 + 1e-9) + 1


@dataclass
class Node:
    bounds: np.ndarray
    rows: Rows | None = None
    below: tuple[Node, Node] | None = None


def ball_tree(rows: Rows, space: Space) -> Node:
    """Halves the rows along the line between two that lie far apart, down to leaves."""
    centroid, bounds = space.bounds(rows)
    if len(rows.ids) <= LEAF:
        return Node(bounds, rows)
    lengths = np.add.reduceat((rows.values * space.stretch[rows.terms]) ** 2, rows.starts[:-1])

    def farthest(point: np.ndarray) -> np.ndarray:
        at = int(np.argmax(lengths - 2 * rows.dot(point * space.stretch)))
        one = rows.take(np.array([at]))
        return np.bincount(one.terms, one.values * space.stretch[one.terms], len(point))

    first = farthest(centroid)
    along = rows.dot((farthest(first) - first) * space.stretch)
    order = np.argsort(along, kind="stable")
    half = len(order) // 2
    return Node(bounds, below=tuple(ball_tree(rows.take(np.sort(part)), space) for part in (order[:half], order[half:])))


class Best:
    """The highest scores of one item so far, equal ones by id with NULL last."""

    def __init__(self, top: int) -> None:
        self.top, self.least = top, 1
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, rows: Rows) -> None:
        good = np.flatnonzero(scores >= self.least)
        if not len(good):
            return
        scores = np.concatenate([self.scores, scores[good]])
        ids, missing = np.concatenate([self.ids, rows.ids[good]]), np.concatenate([self.missing, rows.missing[good]])
        order = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])


def search(tree: Node, item: int, dense: np.ndarray, best: Best) -> int:
    """Best-first; ``dense`` has the item's weights. Returns the number of leaves that were scored."""
    heap, count, leaves = [(-tree.bounds[item], 0, tree)], 1, 0
    while heap and -heap[0][0] >= best.least:
        _, _, node = heapq.heappop(heap)
        if node.below is None:
            leaves += 1
            best.add(node.rows.dot(dense), node.rows)
            continue
        for child in node.below:
            if child.bounds[item] >= best.least:
                heapq.heappush(heap, (-child.bounds[item], count, child))
                count += 1
    return leaves


def searched(rows: DataFrame, items: Items, weights: Weights, top: int) -> DataFrame:
    """``item``, ``score``, ``id``: the best of every task."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        space = Space(items, weights)
        best = [Best(top) for _ in range(len(items))]
        held, entries = [], 0

        def worked_off() -> None:
            part = pa.Table.from_batches(held).combine_chunks()
            lengths = part.column("terms").combine_chunks().value_lengths().to_numpy()
            times = part.column("times").combine_chunks().flatten().to_numpy()
            ids = part.column("id").combine_chunks()
            docs = Rows(
                ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]),
                part.column("terms").combine_chunks().flatten().to_numpy().astype(np.int64),
                weights.values(times, np.repeat(part.column("n").to_numpy(), lengths)),
            )
            tree = ball_tree(docs, space)
            dense = np.zeros(len(weights.terms), dtype=np.int64)
            for item in range(len(items)):
                own = items.terms[items.starts[item] : items.starts[item + 1]]
                dense[own] = weights.terms[own]
                search(tree, item, dense, best[item])
                dense[own] = 0

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                held.append(part)
                entries += len(part.column(2).flatten())
                if entries >= TREE_ENTRIES or sum(each.num_rows for each in held) >= TREE_DOCS:
                    worked_off()
                    held, entries = [], 0
        if held and entries:
            worked_off()
        for item, found in enumerate(best):
            columns = [pa.array(np.full(len(found.ids), item, np.int32)), pa.array(found.scores), pa.array(found.ids, mask=found.missing)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "score", "id"])

    asked = rows.filter(F.size("terms") > 0).select("id", "n", "terms", "times")
    return asked.mapInArrow(made, "item int, score long, id long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """Adds the ``rank`` in each item, first within salts, so that no task holds what all tasks found."""
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    salted = Window.partitionBy("item", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS))).orderBy(*order)
    some = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


def best_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id"
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` documents with a score above 0 of each item.

    Terms are runs of letters, digits and characters beyond ASCII, with A to Z in lower case. NULL texts have
    none; a document without terms counts nowhere, an item without terms has no rows. Documents with
    one id, or none, are ranked each for itself, NULL ids last among equals; so are items. Items come to
    the driver in blocks of ``ITEMS``, and each block is one pass over the documents. An empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(key).cast("long").alias("id"), whole(F.col(text)).alias("text"))
    asked = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rest = asked.toLocalIterator()
    while block := list(islice(rest, ITEMS)):
        block = [row for row in block if any(terms_of(row["text"]))]
        wanted = Items.of([row["text"] for row in block])
        if not len(wanted):
            continue
        rows = matched(texts, wanted)
        best = ranked(searched(rows, wanted, Weights.of(rows, wanted), top), top)
        names = named_items(spark, [row["item_id"] for row in block])
        result = result.union(best.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return result


def named_items(spark: SparkSession, ids: list[int | None]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH found AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents WHERE text IS NOT NULL
), sized AS (SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM found WHERE len(terms) > 0),
totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sized),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark WHERE text IS NOT NULL
), each AS (SELECT doc_id, n, unnest(terms) AS term FROM sized),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM each WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term, documents
), scored AS (
    SELECT item_id, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // length)))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weighed USING (term), totals GROUP BY item_id, doc_id
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 50
"""
