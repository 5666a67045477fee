"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical without their white space. Spark's map-side aggregate first
merges the copies that a task reads; groups salted by task are merged next, so a text that fills a
third of the corpus is spread over ``salts`` reducers; the salt winners meet in one last merge, where
each salt contributes one row per text and length. Every merge has the whole normalised text in its
key, so a digest is never trusted on its own: it only deals out rows. Documents look up their group
by digest afterwards, which is allowed once the merged groups have shown that no digest has two texts;
if one had, the lookup would compare texts too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.text import SPACE, packed, table, whole
from tripflow.session import stage

SALTS = 16


def normal_text(text: Column) -> Column:
    return F.regexp_replace(whole(text), f"[{SPACE}]+", "")


def text_groups(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text of ``id``, ``content``, ``digest``, ``n_chars``.

    Of equal texts the longest original wins, then the smallest id (a NULL id loses).
    """
    shortest = [F.sum("n").alias("n"), F.min("id").alias("id")]
    salted = (
        keyed.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("salt", "digest", "content", "n_chars")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    )
    return (
        salted.repartition("digest")
        .groupBy("digest", "content", "n_chars")
        .agg(*shortest)
        .groupBy("digest", "content")
        .agg(
            F.sum("n").alias("group_size"),
            F.max_by("id", "n_chars").alias("keep_id"),
            F.max("n_chars").alias("keep_chars"),
        )
    )


def mark_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows as struct ``row`` with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    NULL and empty texts, and those of white space only, are equal. Rows that share text, length and
    id are told apart by where they were read: exactly one of them is kept. Other columns, whatever
    their names, travel in ``row``. An empty table gives no rows.
    """
    content = normal_text(F.col(text))
    keyed = packed(
        docs,
        id=F.col(key),
        content=content,
        digest=F.sha2(content, 256),
        n_chars=F.length(whole(F.col(text))),
    )
    groups = text_groups(keyed.drop("row"))
    shared = F.expr("count(*) OVER (PARTITION BY digest) > 1")
    groups = groups.withColumn("shared", shared)
    slim = stage(groups.drop("content"), "dedup-groups")
    on = ["digest"]
    if slim.filter("shared").isEmpty():
        keyed, groups = keyed.drop("content"), slim
    else:
        on = ["digest", "content"]
    wins = (F.col("n_chars") == F.col("keep_chars")) & F.col("id").eqNullSafe(F.col("keep_id"))
    marked = keyed.join(groups, on).withColumn("kept", wins)
    if not docs.groupBy(key).count().filter("count > 1").isEmpty():
        marked = stage(marked.withColumn("at", F.monotonically_increasing_id()), "dedup-rows")
        first = marked.filter("kept").groupBy(*on).agg(F.min("at").alias("first"))
        marked = marked.join(first, on).withColumn("kept", F.col("at") == F.col("first"))
    return marked.select("row", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return mark_duplicates(docs, key, text).filter("kept").select("row.*")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    marked = mark_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY content) AS group_size,
  row_number() OVER best = 1 AS kept,
  sha256(content) AS text_sha256
FROM keyed
WINDOW best AS (PARTITION BY content ORDER BY n_chars DESC, doc_id)
"""
