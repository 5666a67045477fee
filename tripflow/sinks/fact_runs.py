"""Writes of a published trip fact: append, rebuild, upsert by file, and the months that got rows since.

Every function stages a run and returns the folders that would make up the months it replaces. Nothing
is visible before ``publish`` is given them, so a caller can test the months first (``with_change``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import BRONZE, BRONZE_PARTITIONS, FACT, FACT_PARTITIONS
from tripflow.functions import month_start
from tripflow.operators.fact import fact_trips
from tripflow.operators.merge import delete_insert_facts
from tripflow.operators.silver import silver_trips
from tripflow.session import drop_path, scratch_path
from tripflow.sinks.fact import _by_month, _in_order, months_of, of_months, picked_up_in
from tripflow.sinks.published import partition_name, stage_run
from tripflow.sinks.tables import CODEC
from tripflow.sources.published import RUN, Folder, file_place, last_of, log_of, read_folders, readable
from tripflow.sources.tables import latest_pickup


@dataclass(frozen=True)
class Change:
    """Folders staged for some months, and the high-water mark where the run used one."""

    folders: list[Folder]
    mark: datetime | None = None


def month_name(month: datetime | None) -> str:
    return partition_name({FACT_PARTITIONS[0]: month})


def month_of_name(name: str) -> datetime | None:
    text = name.partition("=")[2]
    return None if text == "__HIVE_DEFAULT_PARTITION__" else datetime.fromisoformat(text.replace("%3A", ":"))


def staged(rows: DataFrame, path: str, by_time: bool = False) -> dict[str, Folder]:
    """Writes the rows as a run; ``by_time`` tells that they lie in ranges of pickup time. Which months it has, and from which raw files, is noted as they pass by:
    one pair for every month and file that meet, a list bounded by the calendar."""
    seen = Observation("staged")
    pairs = F.collect_set(F.struct(F.col(FACT_PARTITIONS[0]).alias("month"), F.col("_source_file").alias("file")))
    rows = rows.observe(seen, pairs.alias("pairs"))
    run = stage_run(_in_order(rows) if by_time else _by_month(rows), path, FACT_PARTITIONS)
    files: dict[str, list[str]] = {}
    for pair in seen.get["pairs"]:
        own = files.setdefault(month_name(pair["month"]), [])
        own += [pair["file"]] if pair["file"] is not None else []
    return {name: Folder(name, f"{run}/{name}", sources=sorted(own)) for name, own in files.items()}


def load_all(spark: SparkSession, path: str, bronze: DataFrame, upto: int | None = None) -> Change:
    """A full refresh from bronze, for ``publish_all``. ``upto`` is the last publication that bronze shows."""
    return Change(_upto(staged(fact_trips(silver_trips(bronze, by_time=True)), path, by_time=True), upto))


def _upto(folders: dict[str, Folder], seq: int | None) -> list[Folder]:
    return [replace(folder, upto=seq) for folder in folders.values()]


def append_run(spark: SparkSession, path: str, bronze: DataFrame, upto: int | None = None) -> Change:
    """Trips picked up after the newest stored one, as in ``append_new_trips``.

    The mark's month is staged again together with its new rows and keeps its old ``upto``, since
    rows behind the mark are still missing from it; months after it are complete.
    """
    log = log_of(spark, path)
    stored = read_folders(spark, path, FACT, readable(log, True))
    mark = latest_pickup(stored).first()["pickup_datetime"]
    if mark is None:
        return load_all(spark, path, bronze, upto)
    newer = bronze.filter(F.col("tpep_pickup_datetime") > F.lit(str(mark)).cast("timestamp_ntz"))
    new = fact_trips(silver_trips(newer, by_time=True))
    current = datetime(mark.year, mark.month, 1)
    folders = staged(of_months(stored, [current]).unionByName(new), path, by_time=True)
    old = {entry.partition: entry.upto for entry in readable(log, True)}.get(month_name(current))
    return Change([replace(f, upto=old if name == month_name(current) else upto) for name, f in folders.items()], mark)


def rebuild_run(
    spark: SparkSession, path: str, bronze: DataFrame, months: Sequence[datetime], upto: int | None = None
) -> Change:
    """Whole pickup months from bronze. Months without rows become empty. Nothing stored is read."""
    if not months:
        return Change([])
    folders = staged(fact_trips(silver_trips(picked_up_in(bronze, months), by_time=True)), path, by_time=True)
    empty = [Folder(month_name(month), None, upto=upto) for month in months if month_name(month) not in folders]
    return Change([*_upto(folders, upto), *empty])


def months_from(log: Iterable[Folder], files: Iterable[str]) -> list[datetime]:
    """Stored months with rows of some raw files. The log knows; no column of the fact is read."""
    wanted = set(files)
    found = {month_of_name(entry.partition) for entry in readable(list(log), True) if wanted & set(entry.sources)}
    return sorted(month for month in found if month is not None)


def touched_by(spark: SparkSession, path: str, delivered: DataFrame, files: Iterable[str]) -> list[datetime]:
    """Months to rebuild after a delivery: those of its rows, and those that hold rows of its files."""
    return sorted({*months_of(delivered, "tpep_pickup_datetime"), *months_from(log_of(spark, path), files)})


def stale_months(spark: SparkSession, path: str, bronze_path: str) -> list[datetime]:
    """Pickup months that the fact does not yet show as the months of bronze that passed have them.

    The second mark: a month of the fact says up to which publication of bronze it was built. It is stale
    when a later one has rows for it, or replaced or withdrew a raw file it holds rows of. Only folders
    published after the oldest mark are read, of them the pickup time alone; nothing of the fact is.
    """
    log = log_of(spark, path)
    marks = {entry.partition: entry.upto or 0 for entries in last_of(log).values() for entry in entries}
    newer = [
        entry for entries in last_of(log_of(spark, bronze_path)).values() for entry in entries
        if entry.seq > min(marks.values(), default=0)
    ]
    late = {
        month_of_name(entry.partition) for entry in readable(log, True)
        if any(delivery.seq > (entry.upto or 0) and set(delivery.sources) & set(entry.sources) for delivery in newer)
    }
    published = {delivery.partition: delivery.seq for delivery in newer}
    rows = read_folders(spark, bronze_path, BRONZE, newer)
    pairs = rows.select(*BRONZE_PARTITIONS, month_start(F.col("tpep_pickup_datetime")).alias("month")).distinct()
    for pair in pairs.filter("month IS NOT NULL").collect():  # months of deliveries by months of pickups
        seq = published[partition_name({name: pair[name] for name in BRONZE_PARTITIONS})]
        if seq > marks.get(month_name(pair["month"]), 0):
            late.add(pair["month"])
    return sorted(month for month in late if month is not None)


def upsert_run(spark: SparkSession, path: str, batch: DataFrame, key: str = "trip_id") -> Change:
    """Delete by key and insert, rewriting only the files that hold a replaced key.

    Of the stored months the batch touches, only 64-bit hashes of keys and file names are joined with those of the
    batch (two keys of one hash would at worst rewrite a file that need not be). Files with a hit are read in full, lose the replaced rows and are written together with the batch into a
    new folder; all others stay where they are. A month is then several folders; ``compact_run`` makes it
    one again. The list of files with a hit is no longer than the files of those months.
    """
    copy = scratch_path(spark, "fact-batch")
    batch.write.option("compression", CODEC).parquet(copy)
    batch = spark.read.schema(batch.schema).parquet(copy)
    names = {month_name(month) for month in months_of(batch, "pickup_datetime")}
    if not batch.filter("pickup_datetime IS NULL").isEmpty():
        names.add(month_name(None))
    held = [entry for entry in readable(log_of(spark, path), True) if entry.partition in names]
    own = [entry for entry in held if entry.folder.startswith(RUN)]
    adopted = [entry for entry in held if entry not in own]  # from before the log: written anew as a whole
    stored = read_folders(spark, path, FACT, own, with_place=True)
    hashed = F.xxhash64(key).alias("_hash")
    replaced = batch.filter(F.col(key).isNotNull()).select(hashed)
    hit = stored.filter(F.col(key).isNotNull()).select(hashed, "_place").join(replaced, "_hash", "left_semi").select("_place").distinct()
    files = sorted(row["_place"] for row in hit.collect())
    rewritten = read_folders(spark, path, FACT, adopted)
    if files:
        rewritten = rewritten.unionByName(stored.filter(F.col("_place").isin(files)).drop("_place"))
    folders = staged(delete_insert_facts(rewritten, batch, key), path, by_time=True)
    drop_path(spark, copy)
    changed = []
    for entry in own:
        inside = [place for place in files if place.startswith(f"{_encoded(entry.folder)}/")]
        changed.append(replace(entry, excluded=sorted({*entry.excluded, *inside}), passed=True))
    known = {entry.partition: entry.upto for entry in held}
    return Change([*changed, *[replace(f, upto=known.get(name)) for name, f in folders.items()]])


def _encoded(folder: str) -> str:
    """A folder as file names in ``_metadata`` have it."""
    return folder.replace("%", "%25").replace(" ", "%20")


def compact_run(spark: SparkSession, path: str, most: int = 1) -> Change:
    """Months that lie in more than ``most`` folders or hide files, each written as one folder again."""
    changed = []
    state = last_of(log_of(spark, path))
    for name, entries in state.items():
        own = [entry for entry in entries if entry.folder is not None]
        if len(own) > most or any(entry.excluded for entry in own):
            changed += own
    if not changed:
        return Change([])
    folders = staged(read_folders(spark, path, FACT, changed), path)
    known = {entry.partition: entry.upto for entry in changed}
    empty = [Folder(name, None, upto=seq) for name, seq in known.items() if name not in folders]
    return Change([*[replace(f, upto=known[name]) for name, f in folders.items()], *empty])


def with_change(spark: SparkSession, path: str, change: Change) -> DataFrame:
    """The fact as it would read after the change is published."""
    named = {entry.partition for entry in change.folders}
    kept = [entry for entry in readable(log_of(spark, path), True) if entry.partition not in named]
    return read_folders(spark, path, FACT, [*kept, *change.folders])
