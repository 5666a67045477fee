"""Stored trip fact: full load, append by high-water mark, upsert, and rebuild of months."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import FACT, FACT_PARTITIONS
from tripflow.functions import month_start
from tripflow.operators.fact import fact_trips, later_than
from tripflow.operators.merge import delete_insert_facts
from tripflow.operators.silver import silver_trips
from tripflow.session import drop_path, scratch_path
from tripflow.sinks.tables import CODEC, clear_partition, replace_partitions
from tripflow.sources.tables import latest_pickup, read_fact


def _by_month(fact: DataFrame) -> DataFrame:
    """Brings a month's rows together for writing; AQE splits large months and joins small ones,
    so files come out near the advisory size whatever share of the rows one month holds. The
    writer sorts by month anyway; going on by pickup time gives row groups narrow time ranges.
    """
    rows = fact.hint("rebalance", *FACT_PARTITIONS)
    return rows.sortWithinPartitions(*FACT_PARTITIONS, "pickup_datetime")


def _in_order(fact: DataFrame) -> DataFrame:
    """For rows that lie in ranges of pickup time (or in files of some months): they are written where they are.
    A task then has a month or a few neighbouring ones, so files are as many as tasks and months."""
    return fact.sortWithinPartitions(*FACT_PARTITIONS, "pickup_datetime")


def write_fact(fact: DataFrame, path: str, by_time: bool = False) -> None:
    """First load or full refresh. ``by_time`` tells that the rows lie in ranges of pickup time."""
    (
        (_in_order(fact) if by_time else _by_month(fact))
        .write.mode("overwrite")
        .option("compression", CODEC)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*FACT_PARTITIONS)
        .parquet(path)
    )


def upsert_fact(spark: SparkSession, path: str, batch: DataFrame) -> None:
    """Delete by ``trip_id`` and insert, rewriting only the months the batch has rows in.

    A trip's key covers its pickup time, so equal keys share a month. The batch is staged
    because it is read several times, and the copy deleted at the end. Its months, at most 12 per
    calendar year, come to the driver so that the target's partitions are pruned by literals. Trips
    without a pickup time make a partition of their own, which is read and rewritten like a month.
    """
    copy = scratch_path(spark, "fact-batch")
    batch.write.option("compression", CODEC).parquet(copy)
    batch = spark.read.schema(batch.schema).parquet(copy)
    undated = not batch.filter("pickup_datetime IS NULL").isEmpty()
    stored = read_fact(spark, path)
    touched = of_months(stored, months_of(batch, "pickup_datetime"), undated)
    replace_partitions(_in_order(delete_insert_facts(touched, batch)), path, FACT_PARTITIONS)
    drop_path(spark, copy)


def append_new_trips(
    spark: SparkSession, path: str, silver: DataFrame, by_time: bool = False
) -> datetime | None:
    """Loads the trips picked up after the newest stored one; returns the mark it used.

    The mark is fetched first (one value), so it reaches the bronze scan as a literal. No
    stored key can come again after it, so nothing is looked up: the mark's own month is
    rewritten together with the new rows, and older months are not read. Late rows never
    pass the mark: use ``rebuild_months`` for late or re-delivered data. ``by_time`` tells that
    silver lies in ranges of pickup time; then nothing is shuffled for the write.
    """
    stored = read_fact(spark, path)
    mark = latest_pickup(stored).first()["pickup_datetime"]
    if mark is None:
        write_fact(fact_trips(silver), path, by_time)
        return None
    new = fact_trips(later_than(silver, F.lit(str(mark)).cast("timestamp_ntz")))
    current = of_months(stored, [datetime(mark.year, mark.month, 1)])
    rows = current.unionByName(new)
    replace_partitions(_in_order(rows) if by_time else _by_month(rows), path, FACT_PARTITIONS)
    return mark


def months_of(rows: DataFrame, pickup: str) -> list[datetime]:
    """Distinct pickup months, a list bounded by the calendar."""
    months = rows.select(month_start(F.col(pickup)).alias("month")).distinct()
    return sorted(row["month"] for row in months.filter("month IS NOT NULL").collect())


def of_months(fact: DataFrame, months: Iterable[datetime], undated: bool = False) -> DataFrame:
    """Stored facts of some months; only their partitions are listed in the plan. ``undated`` adds
    those without a month."""
    wanted = ", ".join(f"timestamp_ntz'{month:%Y-%m-%d}'" for month in months)
    parts = [f"pickup_month IN ({wanted})"] if wanted else []
    parts += ["pickup_month IS NULL"] if undated else []
    return fact.filter(" OR ".join(parts) or "false")


def touched_months(
    spark: SparkSession, bronze_periods: DataFrame, path: str, files: Iterable[str] = ()
) -> list[datetime]:
    """Pickup months to rebuild after some bronze periods were reloaded.

    Months of the new rows, plus months that still hold rows of the reloaded files. Name those in
    ``files``, or a delivery without rows leaves no trace of itself. The names are literals, so that
    Parquet dictionaries rule out row groups without them. All lists are bounded by the calendar.
    """
    names = {row["_source_file"] for row in bronze_periods.select("_source_file").distinct().collect()}
    stored = read_fact(spark, path).filter(F.col("_source_file").isin(sorted({*names, *files})))
    new = months_of(bronze_periods, "tpep_pickup_datetime")
    return sorted({*new, *months_of(stored, "pickup_month")})


def picked_up_in(bronze: DataFrame, months: Iterable[datetime]) -> DataFrame:
    """Bronze rows of some pickup months, as plain ranges that Parquet statistics can prune.

    Months in a row are one range.
    """
    ranges: list[list[datetime]] = []
    for month in sorted(months):
        if ranges and ranges[-1][1] == month:
            ranges[-1][1] = _next_month(month)
        else:
            ranges.append([month, _next_month(month)])
    stamp = lambda moment: f"timestamp_ntz'{moment:%Y-%m-%d}'"
    parts = [
        f"(tpep_pickup_datetime >= {stamp(first)} AND tpep_pickup_datetime < {stamp(after)})"
        for first, after in ranges
    ]
    return bronze.filter(" OR ".join(parts) or "false")


def rebuild_months(
    spark: SparkSession, path: str, bronze: DataFrame, months: Sequence[datetime]
) -> None:
    """Recomputes whole pickup months from bronze, as a full refresh would.

    Copies of a trip share their pickup time, so a month can be deduplicated by itself:
    nothing of the stored fact is read, and repeating the call changes nothing.
    """
    if not months:
        return
    filled = Observation("rebuild_months")
    fact = fact_trips(silver_trips(picked_up_in(bronze, months), by_time=True)).observe(
        filled, F.collect_set("pickup_month").alias("months")
    )
    replace_partitions(_in_order(fact), path, FACT_PARTITIONS)
    written = set(filled.get["months"])
    for month in months:
        if month not in written:
            clear_partition(spark, path, FACT, {"pickup_month": month})


def _next_month(month: datetime) -> datetime:
    return datetime(month.year + month.month // 12, month.month % 12 + 1, 1)
