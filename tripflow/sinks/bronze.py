"""Bronze loads: replace whole months and reconcile their row counts."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import BRONZE, BRONZE_PARTITIONS
from tripflow.operators.silver import in_periods
from tripflow.sinks.published import partition_name, publish, stage_run
from tripflow.sinks.tables import clear_partition, replace_partitions
from tripflow.sources.footers import filled_counts, folder_footers, read_footers
from tripflow.sources.landing import landing_files, landing_name, read_landing, scan_month
from tripflow.sources.published import Folder, is_published, last_of, log_of, read_folders
from tripflow.sources.tables import read_bronze_month


@dataclass(frozen=True)
class LoadStats:
    year: int
    month: int
    input_count: int
    output_count: int
    duration_seconds: float

    @property
    def reconciled(self) -> bool:
        return self.input_count == self.output_count

    def to_frame(self, spark: SparkSession) -> DataFrame:
        schema = (
            "year int, month int, input_count bigint, output_count bigint, duration_seconds double"
        )
        return spark.createDataFrame([tuple(asdict(self).values())], schema)


def load_month(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    year: int,
    month: int,
    dataset: str = "yellow",
    ingested_at: datetime | str | None = None,
) -> LoadStats:
    """Replaces one month of bronze from its raw file; running it again gives the same table.

    The write is map-only: a raw month is one partition, so nothing is shuffled, and the
    input count is observed while the rows pass by. A published table takes the month as a delivery that
    is still to be judged; what the month held before stays as it is.
    """
    started = time.monotonic()
    rows = Observation("load_month")
    month_rows = scan_month(spark, landing_root, year, month, dataset, ingested_at).observe(
        rows, F.count(F.lit(1)).alias("input_count")
    )
    if is_published(spark, bronze_path):
        run = stage_run(month_rows, bronze_path, BRONZE_PARTITIONS)
        input_count = rows.get["input_count"]
        delivery = delivered(year, month, dataset, run if input_count else None)
        publish(spark, bronze_path, [delivery])
        output_count = read_folders(spark, bronze_path, BRONZE, [delivery]).count()
        return LoadStats(year, month, input_count, output_count, time.monotonic() - started)
    replace_partitions(month_rows, bronze_path, BRONZE_PARTITIONS)
    input_count = rows.get["input_count"]
    if input_count == 0:
        clear_partition(spark, bronze_path, BRONZE, {"_year": year, "_month": month})
    output_count = read_bronze_month(spark, bronze_path, year, month).count()
    return LoadStats(year, month, input_count, output_count, time.monotonic() - started)


def delivered(year: int, month: int, dataset: str, run: str | None) -> Folder:
    """A log entry for a month that is not judged yet; without a run it has no rows."""
    name = partition_name({"_year": year, "_month": month})
    return Folder(name, run and f"{run}/{name}", passed=False, sources=[landing_name(year, month, dataset)])


def deliveries(spark: SparkSession, bronze_path: str, periods: Iterable[tuple[int, int]]) -> list[Folder]:
    """The last delivery of each month of a published table, judged or not."""
    names = {partition_name({"_year": year, "_month": month}) for year, month in periods}
    return [entry for name, entries in last_of(log_of(spark, bronze_path), None).items() if name in names for entry in entries]


def load_landing(
    spark: SparkSession,
    bronze_path: str,
    *paths: str,
    dataset: str = "yellow",
    ingested_at: datetime | str | None = None,
) -> DataFrame:
    """Replaces every month found under the paths in one map-only job; returns its reconciliation.

    For backfills, also of deliveries whose column types differ. A published table takes the months as
    deliveries that are still to be judged (``judge_periods``); until then they read as before.
    """
    incoming = read_landing(spark, *paths, dataset=dataset, ingested_at=ingested_at)
    published = is_published(spark, bronze_path)
    if published:
        run = stage_run(incoming, bronze_path, BRONZE_PARTITIONS)
    else:
        replace_partitions(incoming, bronze_path, BRONZE_PARTITIONS)
    # One row per delivered month, at most 12 per year of deliveries.
    months = landing_files(spark, *paths).select(*BRONZE_PARTITIONS).distinct()
    found = months.join(count_rows(incoming, "input_count"), BRONZE_PARTITIONS, "left")
    counted = found.fillna(0, ["input_count"]).collect()
    if published:
        entries = [delivered(row["_year"], row["_month"], dataset, run if row["input_count"] else None) for row in counted]
        publish(spark, bronze_path, entries)
        inputs = spark.createDataFrame(counted, found.schema)
        return reconcile(inputs, count_rows(folder_footers(spark, bronze_path, BRONZE, entries), "output_count"))
    for row in counted:
        if not row["input_count"]:
            values = {name: row[name] for name in BRONZE_PARTITIONS}
            clear_partition(spark, bronze_path, BRONZE, values)
    stored = in_periods(
        read_footers(spark, bronze_path, BRONZE), [(row["_year"], row["_month"]) for row in counted]
    )
    inputs = spark.createDataFrame(counted, found.schema)
    return reconcile(inputs, count_rows(stored, "output_count"))


def count_rows(bronze: DataFrame, name: str) -> DataFrame:
    """Rows per month, of a stored table (``sources.footers``) answered by the footers of its files."""
    return filled_counts(bronze, BRONZE_PARTITIONS, []).withColumnRenamed("rows", name)


def reconcile(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input and output rows of every month on either side; a difference is only reported."""
    both = inputs.join(outputs, BRONZE_PARTITIONS, "full")
    rows = {name: F.coalesce(name, F.lit(0)) for name in ("input_count", "output_count")}
    difference = rows["input_count"] - rows["output_count"]
    return both.select(
        F.col("_year").alias("year"),
        F.col("_month").alias("month"),
        rows["input_count"].alias("input_count"),
        rows["output_count"].alias("output_count"),
        difference.alias("difference"),
        (difference == 0).alias("reconciled"),
    )
