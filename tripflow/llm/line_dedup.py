"""Deleting later copies of repeated line runs, by a suffix array over the sequences of line ids.

The suffix array is built by prefix doubling. Lines that occur once end every run and leave first; so do
stretches between them that have too few words. Round k ranks all runs of 2^k lines: a run's rank is the
place of the pair (rank of its first half, rank of its second half) in a range sort of all distinct pairs
that occur more than once, so ranks are in the order of the suffixes that start with the runs. Round 0 ranks
the lines themselves, told apart by 128 bits (two hashes of different seeds). A window
over a document's own lines brings the halves together; only distinct pairs meet across documents,
counted before they are shuffled, so a frequent line is one row per task. Runs that occur once leave.

Suffixes whose longest common prefix has at least l lines form an interval of the array; for 2^k <= l <
2^(k+1) the ranks of the first and of the last 2^k lines of the prefix name it. A run of at least
``MIN_WORDS`` words that occurs earlier in the corpus is a copy. All lines of all copies are covered by
the shortest runs with that many words that start or end at a line, so for each line two intervals are
looked up, and all members of an interval but the first one are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.text import SPACE, packed, table, whole
from tripflow.session import stage

MIN_WORDS = 50


def placed_rows(docs: DataFrame, key: str) -> DataFrame:
    """Rows as struct ``row`` with ``at``, unique and in the order of the key (NULL last).

    That is the key itself if it is unique. Otherwise a copy of the rows is written in that order, where rows
    of one key, or without one, go by their place in the input and may spread over many tasks.
    """
    repeated = docs.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1))
    if repeated.isEmpty():
        return packed(docs, at=F.col(key).cast("long"))
    order = F.col(f"row.`{key}`").asc_nulls_last()
    rows = packed(docs).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(order, "place").sortWithinPartitions(order, "place").drop("place")
    return stage(rows.withColumn("at", F.monotonically_increasing_id()), "line-rows")


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n")


def line_hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("hash"), F.xxhash64(F.lit(1), text).alias("other")


def repeated_stretches(rows: DataFrame, text: str, min_words: int) -> DataFrame:
    """``at``, ``i``, ``line`` (its rank), ``words`` of lines in stretches of repeated lines with enough words.

    ``stretch`` numbers consecutive lines of a document; ``upto`` is its running sum of words.
    """
    split = rows.select("at", F.posexplode(lines_of(F.col(f"row.`{text}`"))).alias("i", "text"))
    lines = split.select(
        "at",
        "i",
        *line_hashes(F.col("text")),
        F.regexp_count("text", F.lit(f"[^{SPACE}]+")).cast("long").alias("words"),
    )
    repeated = lines.groupBy("hash", "other").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash", "other")
    ordered = repeated.repartitionByRange("hash", "other").sortWithinPartitions("hash", "other")
    ranked = stage(ordered.withColumn("line", F.monotonically_increasing_id()), "line-ids")
    order = Window.partitionBy("at").orderBy("i")
    stretch = Window.partitionBy("at", "stretch")
    ids = lines.join(ranked, ["hash", "other"]).select("at", "i", "line", "words")
    kept = ids.withColumn("stretch", F.col("i") - F.row_number().over(order))
    kept = kept.withColumn("total", F.sum("words").over(stretch)).filter(F.col("total") >= min_words)
    return kept.withColumn("upto", F.sum("words").over(stretch.orderBy("i"))).drop("total")


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``at``, ``first``, ``length`` of the shortest runs with enough words from and up to each line."""
    before = F.col("upto") - F.col("words")
    running = Window.partitionBy("at", "stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seek = lambda value, mark: lines.select("at", "stretch", "i", value.alias("value"), F.lit(mark).alias("asks"))
    # Going down the running sums, the last end seen is the nearest one that reaches what a start needs.
    ends = seek(F.col("upto"), False).union(seek(before + min_words, True))
    down = running.orderBy(F.desc("value"), "asks", F.desc("i"))
    end = F.last(F.when(~F.col("asks"), F.col("i")), ignorenulls=True).over(down)
    forward = ends.withColumn("found", end).filter("asks AND found IS NOT NULL")
    # Going up, the last start seen is the nearest one that leaves enough words up to an end.
    starts = seek(before, False).union(seek(F.col("upto") - min_words, True))
    up = running.orderBy("value", "asks", "i")
    start = F.last(F.when(~F.col("asks"), F.col("i")), ignorenulls=True).over(up)
    backward = starts.withColumn("found", start).filter("asks AND found IS NOT NULL")
    run = lambda first, last: (first.alias("first"), (last - first + 1).cast("int").alias("length"))
    return (
        forward.select("at", *run(F.col("i"), F.col("found")))
        .union(backward.select("at", *run(F.col("found"), F.col("i"))))
        .distinct()
    )


def suffix_ranks(lines: DataFrame, longest: int) -> DataFrame:
    """``at``, ``i``, ``level``, ``rank`` of all runs of 2^level lines that occur more than once."""
    level = 0
    ranks = lines.select("at", "i", F.lit(0).alias("level"), F.col("line").alias("rank"))
    levels = ranks
    while 2 << level <= longest:
        half = 1 << level
        ahead = Window.partitionBy("at").orderBy("i").rangeBetween(half, half)
        pairs = ranks.withColumn("next", F.max("rank").over(ahead)).filter("next IS NOT NULL")
        pairs = stage(pairs.select("at", "i", "rank", "next"), "line-pairs")
        distinct = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        order = (
            distinct.select("rank", "next").repartitionByRange("rank", "next").sortWithinPartitions("rank", "next")
            .withColumn("place", F.monotonically_increasing_id())
        )
        order = stage(order, "line-ranks")
        level += 1
        ranked = pairs.join(order, ["rank", "next"])
        ranks = ranked.select("at", "i", F.lit(level).alias("level"), F.col("place").alias("rank"))
        levels = levels.union(ranks)
        if order.isEmpty():
            break
    return levels


def later_copies(runs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The runs that are in an interval of the suffix array and not its first member."""
    level = F.floor(F.log2("length") + 1e-9).cast("int")
    last = F.expr("first + length - shiftleft(1, level)")
    named = runs.withColumn("level", level).withColumn("last", last.cast("int"))
    head = ranks.select("at", F.col("i").alias("first"), "level", F.col("rank").alias("head"))
    tail = ranks.select("at", F.col("i").alias("last"), "level", F.col("rank").alias("tail"))
    named = named.join(head, ["at", "first", "level"]).join(tail, ["at", "last", "level"])
    interval = ["length", "head", "tail"]
    origin = named.groupBy(*interval).agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("at", "first")).alias("origin")
    ).filter("members > 1")
    copy = F.struct("at", "first") > F.col("origin")
    return named.join(origin, interval).filter(copy).select("at", "first", "length")


def mark_copied_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows as struct ``row`` with ``deleted``, the numbers (from 0) of lines that are copies, in order.

    Earlier means a smaller id, then a smaller line number; rows with equal or NULL ids are documents of
    their own, NULL ids last. A NULL text has one empty line, as an empty one has. Within a document too
    the later copy goes. Other columns travel in ``row``. An empty table gives no rows.
    """
    rows = placed_rows(docs, key)
    lines = stage(repeated_stretches(rows, text, min_words), "lines")
    runs = stage(shortest_runs(lines, min_words), "line-runs")
    longest = runs.agg(F.max("length")).first()[0] or 0
    copies = later_copies(runs, suffix_ranks(lines, longest))
    covered = copies.select("at", F.explode(F.expr("sequence(first, first + length - 1)")).alias("i")).distinct()
    deleted = covered.groupBy("at").agg(F.array_sort(F.collect_list("i")).alias("deleted"))
    none = F.array().cast("array<int>")
    return rows.join(deleted, "at", "left").select("row", F.coalesce("deleted", none).alias("deleted"))


def remaining(text: Column, deleted: Column) -> Column:
    """The text without its deleted lines."""
    lines = lines_of(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), deleted)
    kept = F.transform(left, lambda i: F.get(lines, i))
    return F.when(F.size(deleted) == 0, whole(text)).otherwise(F.array_join(kept, "\n"))


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    marked = mark_copied_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.col("row.text")
    clean = remaining(text, F.col("deleted"))
    return marked.select(
        "row.doc_id",
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.size("deleted").cast("long").alias("n_deleted"),
        F.length(clean).cast("long").alias("clean_chars"),
        F.sha2(clean, 256).alias("clean_sha256"),
    )


# Compares the runs' texts themselves.
SQL = rf"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
counted AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^{SPACE}]+')) AS words FROM numbered),
summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM counted),
runs AS (
  SELECT s.doc_id, s.i AS a, min(e.i) AS b
  FROM summed s JOIN summed e ON e.doc_id = s.doc_id AND e.upto >= s.upto - s.words + {MIN_WORDS}
  GROUP BY ALL
  UNION
  SELECT e.doc_id, max(s.i) AS a, e.i AS b
  FROM summed e JOIN summed s ON e.doc_id = s.doc_id AND s.upto - s.words <= e.upto - {MIN_WORDS}
  GROUP BY e.doc_id, e.i),
texts AS (
  SELECT r.*, lines[a:b] AS content FROM runs r JOIN docs USING (doc_id)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS place FROM texts),
deleted AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ordered WHERE place > 1),
kept AS (
  SELECT n.doc_id, count(*) AS n_lines, count(d.i) AS n_deleted,
    coalesce(string_agg(n.line, chr(10) ORDER BY n.i) FILTER (WHERE d.i IS NULL), '') AS clean
  FROM numbered n LEFT JOIN deleted d ON n.doc_id = d.doc_id AND n.i = d.i
  GROUP BY n.doc_id)
SELECT doc_id, n_lines, n_deleted, length(clean) AS clean_chars, sha256(clean) AS clean_sha256 FROM kept
"""
