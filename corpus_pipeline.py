"""From raw documents to token ids: the stages of a training corpus, in order.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import exact_dedup, language, mixing, near_duplicates, sentencepiece
from tripflow.llm.text import table, whole
from tripflow.session import stage


NEAR_WORDS, NEAR_PERCENT = 5, 80
EVIDENCE = 20


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: NULL and empty texts, texts without a letter, and texts of ``EVIDENCE``
    characters or more of which no n-gram is typical of any language learned. All others stay, whatever their language.
    Without a labelled row there is nothing to learn, and only the first two kinds go."""
    model = language.fit_unheld(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    foreign = (F.col("score") == 0) & (F.length("row.text") >= EVIDENCE)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & ~foreign).select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays, then the smallest id (NULL last); NULL texts
    are empty and equal to each other. Very long texts are compared whole. An empty table stays empty."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id. Five-word n-grams, Jaccard 0.8 or more."""
    return near_duplicates.drop_near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their targets; a NULL source is one, the last.
    A copy is a row with the same values. Texts without words count 0 and stay once. An empty table stays empty."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy in the mix, and whether they decode to its text again."""
    round_trip = F.col("decoded") == whole(F.col("row.text"))
    return sentencepiece.encoded_documents(docs, decoded=True).select(
        "row.doc_id", "row.source", F.size("ids").alias("n_ids"), "ids", round_trip.alias("round_trip")
    )


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing to target weights", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]

# Language filters, multipliers and paths through a lattice are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for step, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if step + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{step}")
    return docs
