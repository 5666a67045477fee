"""Tables whose partitions are published: what is readable is decided by a log, not by the folders.

Every write goes to a run folder of its own, ``<table>/_run=<id>/<partition>/``, and touches no other. A
publication is one small file in ``<table>/_published``: for each partition it replaces, the folders that
make it up from then on. One file appears at once or not at all, so the partitions of a publication change
together and a reader sees them all before or all after. Old folders stay until ``drop_unused``.

A log entry that has not ``passed`` is a delivery that is kept to be judged. A partition reads as its
last publication that passed; one that never had any shows its last delivery unless ``judged`` is asked for.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_published"
RUN_COLUMN = "_run"
RUN = f"{RUN_COLUMN}="
ENTRY = (
    "seq long, partition string, folder string, passed boolean, sources array<string>, "
    "excluded array<string>, upto long"
)


@dataclass(frozen=True)
class Folder:
    """One folder of a partition, or with ``folder`` None the statement that the partition is empty.

    ``sources`` names the raw files its rows come from, ``excluded`` its files that a later run replaced, and
    ``upto`` is the last publication of the layer before that it takes into account.
    """

    partition: str
    folder: str | None
    passed: bool = True
    sources: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    upto: int | None = None
    seq: int = 0


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def is_published(spark: SparkSession, path: str) -> bool:
    return exists(spark, log_path(path))


def log_of(spark: SparkSession, path: str) -> list[Folder]:
    """All entries, oldest first: a few per partition and run."""
    rows = spark.read.schema(ENTRY).parquet(log_path(path)).collect()
    folders = [Folder(**(row.asDict() | {"sources": row["sources"] or [], "excluded": row["excluded"] or []})) for row in rows]
    return sorted(folders, key=lambda entry: (entry.seq, entry.partition, entry.folder or ""))


def last_seq(log: Iterable[Folder]) -> int:
    return max((entry.seq for entry in log), default=0)


def last_of(log: Iterable[Folder], passed: bool | None = True) -> dict[str, list[Folder]]:
    """By partition, the entries of its last publication, or with ``passed`` None of its last entry of any kind."""
    state: dict[str, list[Folder]] = {}
    for entry in log:
        if passed is not None and entry.passed != passed:
            continue
        held = state.setdefault(entry.partition, [])
        if held and held[0].seq < entry.seq:
            held.clear()
        held.append(entry)
    return state


def readable(log: list[Folder], judged: bool) -> list[Folder]:
    passed = last_of(log)
    shown = passed if judged else last_of(log, None) | passed
    return [entry for entries in shown.values() for entry in entries if entry.folder is not None]


def file_place(path: str = "_metadata.file_path") -> Column:
    """A file's place under its table, as ``excluded`` has it."""
    return F.concat(F.lit(RUN), F.substring_index(F.col(path), f"/{RUN}", -1))


def read_folders(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folders: Iterable[Folder],
    with_place: bool = False,
    with_run: bool = False,
) -> DataFrame:
    """The rows of some folders of a table, with ``_place`` (the file of each) or ``_run`` on request.

    Files that a later run replaced are ruled out by name when the scan lists its files.
    """
    added = [name for name, wanted in (("_place", with_place), (RUN_COLUMN, with_run)) if wanted]
    names = [*schema.names, *added]
    frames, root = [], path.rstrip("/")
    for of_run in (True, False):  # folders from before the table had a log lie without a run
        own = [entry for entry in folders if entry.folder is not None and entry.folder.startswith(RUN) == of_run]
        if not own:
            continue
        rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{entry.folder}" for entry in own])
        gone = sorted({place for entry in own for place in entry.excluded})
        if gone:
            rows = rows.filter(~file_place().isin(gone))
        if with_place:
            rows = rows.withColumn("_place", file_place())
        if with_run and not of_run:
            rows = rows.withColumn(RUN_COLUMN, F.lit(None).cast("string"))
        frames.append(rows.select(*names))
    if frames:
        return reduce(DataFrame.unionAll, frames)
    return spark.createDataFrame([], T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in added]]))


def read_published(spark: SparkSession, path: str, schema: T.StructType, judged: bool = False) -> DataFrame:
    return read_folders(spark, path, schema, readable(log_of(spark, path), judged))
