"""Writes of published tables: stage a run, publish it in one step, point the catalog at it.

One writer at a time per table; readers need not wait. A job that fails or is lost between staging and
publishing leaves a run folder that no entry names, and the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.paths import partition_path
from tripflow.session import drop_path
from tripflow.sinks.tables import CODEC, create_table, ensure_table
from tripflow.sources.published import ENTRY, RUN, Folder, exists, is_published, last_of, last_seq, log_of, log_path, readable

TEXTS = pa.list_(pa.string())
COLUMNS = pa.schema(
    [("seq", pa.int64()), ("partition", pa.string()), ("folder", pa.string()), ("passed", pa.bool_()),
     ("sources", TEXTS), ("excluded", TEXTS), ("upto", pa.int64())]
)


def partition_name(values: Mapping[str, object]) -> str:
    return partition_path("", values).lstrip("/")


def ensure_published(
    spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str], adopted: bool | None = None
) -> None:
    """Gives the table a log, unless it has one. Partition folders that are there already become the
    first publication, which has passed unless ``adopted`` is False."""
    if is_published(spark, path):
        return
    held = []
    if exists(spark, path):
        rows = spark.read.schema(schema).parquet(path).select(*partitions).distinct().collect()
        held = [partition_name({name: row[name] for name in partitions}) for row in rows]
    ensure_table(spark, log_path(path), ENTRY)
    publish(spark, path, [Folder(name, name, passed=adopted is not False) for name in held])


def stage_run(rows: DataFrame, path: str, partitions: Sequence[str]) -> str:
    """Writes a run folder that nothing reads yet; returns its name."""
    run = f"{RUN}r{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").option("compression", CODEC).partitionBy(*partitions).parquet(f"{path.rstrip('/')}/{run}")
    return run


def publish(spark: SparkSession, path: str, folders: Iterable[Folder]) -> None:
    """Replaces the partitions named by the folders of the table, all in one step."""
    folders = list(folders)
    if not folders:
        return
    seq = last_seq(log_of(spark, path)) + 1
    entries = pa.Table.from_pylist([asdict(replace(folder, seq=seq)) for folder in folders], schema=COLUMNS)
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("append").parquet(log_path(path))


def publish_all(spark: SparkSession, path: str, folders: Iterable[Folder]) -> None:
    """A full refresh: partitions that are not among the folders become empty."""
    folders = list(folders)
    named = {entry.partition for entry in folders}
    old = [name for name in last_of(log_of(spark, path)) if name not in named]
    publish(spark, path, [*folders, *[Folder(name, None) for name in old]])


def unused_runs(spark: SparkSession, path: str) -> list[str]:
    """Run folders that no readable partition and no delivery still to be judged needs."""
    log = log_of(spark, path)
    last = [entry for entries in last_of(log, None).values() for entry in entries]
    needed = {entry.folder.partition("/")[0] for entry in [*readable(log, False), *last] if entry.folder}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = [status.getPath().getName() for status in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return sorted(name for name in found if name.startswith(RUN) and name not in needed)


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders of replaced, failed and abandoned runs. Not while a run or a long reader is under way."""
    runs = unused_runs(spark, path)
    for run in runs:
        drop_path(spark, f"{path.rstrip('/')}/{run}")
    return runs


def point_catalog(spark: SparkSession, name: str, schema: T.StructType, path: str, partitions: Sequence[str]) -> None:
    """Creates the external table if absent and sets the location of every partition to its published folder.

    Partitions that the log does not name leave the catalog. A partition of several folders has no one
    location: ``compact`` it first.
    """
    log = log_of(spark, path)
    create_table(spark, name, schema, f"{path.rstrip('/')}/_catalog", partitions, recover=False)
    known = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    state = last_of(log)
    unnamed = {other: [] for other in known if not any(_same(other, partition) for partition in state)}
    for partition, entries in (unnamed | state).items():
        folders = [entry for entry in entries if entry.folder is not None]
        if len(folders) > 1 or any(entry.excluded for entry in folders):
            raise ValueError(f"partition {partition} of {name} lies in several folders; compact it first")
        values = dict(part.split("=", 1) for part in partition.split("/"))
        spec = ", ".join(f"{column}={_literal(text, schema[column].dataType)}" for column, text in values.items())
        listed = any(_same(partition, other) for other in known)
        if folders:
            location = f"LOCATION '{path.rstrip('/')}/{folders[0].folder}'"
            if listed:
                spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET {location}")
            else:
                spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) {location}")
        elif listed:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")
    spark.catalog.refreshTable(name)


def _literal(text: str, kind: T.DataType) -> str:
    from urllib.parse import unquote

    if text == "__HIVE_DEFAULT_PARTITION__":
        return "null"
    return unquote(text) if isinstance(kind, T.IntegralType) else f"'{unquote(text)}'"


def _same(one: str, other: str) -> bool:
    from urllib.parse import unquote

    return unquote(one) == unquote(other)
