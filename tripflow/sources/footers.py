"""Stored tables read for counting: Parquet footers answer, no column is read.

Spark's second Parquet source pushes ``count`` of rows and of non-null values, also per partition, into the
scan, which then opens each file once for its footer. That source is chosen by session settings, so such
reads belong to a session beside the caller's, whose own settings stay as they are. Frames of both sessions
may be combined. Anything but counts of whole partitions gives the same result by an ordinary scan.
Extremes are left to ordinary scans: footers have none for timestamps, for values with NaN or for row groups of NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.published import RUN_COLUMN, Folder, is_published, log_of, read_folders, readable

PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings, whose reads of Parquet take pushed counts."""
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            beside.conf.set(key, value)
    for key, value in PUSHED.items():
        beside.conf.set(key, value)
    return beside


def folder_footers(spark: SparkSession, path: str, schema: T.StructType, folders: Iterable[Folder]) -> DataFrame:
    """Folders of a published table, with their runs as ``_run``. Where a later run replaced single files the
    scan has to leave them out by name, which only the ordinary source does."""
    folders = list(folders)
    session = spark if any(entry.excluded for entry in folders) else footer_session(spark)
    return read_folders(session, path, schema, folders, with_run=True)


def read_footers(spark: SparkSession, path: str, schema: T.StructType, judged: bool = False) -> DataFrame:
    """A stored table, in partition folders or published."""
    if is_published(spark, path):
        return folder_footers(spark, path, schema, readable(log_of(spark, path), judged))
    return footer_session(spark).read.schema(schema).parquet(path)


def filled_counts(stored: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``rows`` and, under its own name, the non-null values of every other column, per partition.

    ``by`` names all partition columns. A partition without rows has no row here. NaN is a value. The folders
    of a published table are partitioned by run too, so they are counted by run first.
    """
    names = columns if columns is not None else [name for name in stored.columns if name not in (*by, RUN_COLUMN)]
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count(name).alias(name) for name in names]]
    if RUN_COLUMN not in stored.columns:
        return stored.groupBy(*by).agg(*counts).filter("rows > 0")
    runs = stored.groupBy(RUN_COLUMN, *by).agg(*counts)
    return runs.groupBy(*by).agg(*[F.sum(name).alias(name) for name in ["rows", *names]]).filter("rows > 0")
