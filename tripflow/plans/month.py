"""One reporting month through all layers, in order; a failed gate stops what follows.

Bronze and fact are published tables. A delivery goes to a run folder of its own and is judged there; only
when it passes does it become its month, in one step. A missing, failed or unjudged delivery leaves the
month as it was. The fact's new months are staged and tested in the same way before they are published.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import AUDIT, BRONZE, BRONZE_PARTITIONS, FACT, FACT_PARTITIONS
from tripflow.operators.dimensions import calendar, dim_zones, stg_zones
from tripflow.operators.quality import gate, run_model_tests, run_rules
from tripflow.operators.silver import in_periods, silver_trips
from tripflow.plans.suites import bronze_suite, model_tests
from tripflow.sinks import fact_runs
from tripflow.sinks.bronze import LoadStats, deliveries, load_month
from tripflow.sinks.fact import months_of, of_months
from tripflow.sinks.published import ensure_published, point_catalog, publish
from tripflow.sinks.tables import create_table, overwrite_table
from tripflow.sources.landing import landing_name
from tripflow.sources.footers import folder_footers
from tripflow.sources.published import exists, last_of, last_seq, log_of, read_folders, read_published
from tripflow.sources.seeds import read_zone_seed
from tripflow.sources.tables import read_fact

MODES = ("append", "rebuild", "late")


@dataclass(frozen=True)
class Layout:
    """Where the layers live: one folder per layer under ``root``, raw months elsewhere."""

    root: str
    landing: str
    zone_csv: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    @property
    def bronze(self) -> str:
        return self.path("bronze.trips")

    @property
    def fact(self) -> str:
        return self.path("gold.fact_trips")


def ensure_layers(spark: SparkSession, layout: Layout) -> None:
    ensure_published(spark, layout.bronze, BRONZE, BRONZE_PARTITIONS)
    ensure_published(spark, layout.fact, FACT, FACT_PARTITIONS)


def run_month(
    spark: SparkSession,
    layout: Layout,
    year: int,
    month: int,
    dataset: str = "yellow",
    mode: str = "append",
    scope: str = "month",
    ingested_at: datetime | str | None = None,
) -> LoadStats:
    """Loads, checks, transforms and tests one month.

    ``append`` adds trips later than the newest stored one; ``rebuild`` recomputes the pickup
    months the reloaded data touches, which also takes late and corrected rows; ``late`` recomputes all
    pickup months that got, changed or lost rows by any publication since they were built. Checks cover the
    loaded period and the months it touches, or with scope ``table`` all that has passed before too.
    """
    if mode not in MODES or scope not in ("table", "month"):
        raise ValueError(f"no such mode or scope: {mode!r}, {scope!r}")
    ensure_layers(spark, layout)
    stats = load_month(spark, layout.landing, layout.bronze, year, month, dataset, ingested_at)
    judge_periods(spark, layout, [(year, month)], scope, may_be_empty=mode != "append")
    build_dimensions(spark, layout)
    upto = last_seq(log_of(spark, layout.bronze))
    bronze = passed_bronze(spark, layout)
    loaded = in_periods(bronze, [(year, month)])
    if mode == "append":
        change = fact_runs.append_run(spark, layout.fact, bronze, upto)
    else:
        if mode == "rebuild":
            files = [landing_name(year, month, dataset)]
            months = fact_runs.touched_by(spark, layout.fact, loaded, files)
        else:
            months = fact_runs.stale_months(spark, layout.fact, layout.bronze)
        change = fact_runs.rebuild_run(spark, layout.fact, bronze, months, upto)
    tables = built_tables(spark, layout) | {"fact_trips": fact_runs.with_change(spark, layout.fact, change)}
    if scope == "month":
        tables["silver_trips"] = silver_trips(loaded, columns=tested_columns("silver_trips"))
        months = months_of(loaded, "tpep_pickup_datetime")
        tables["fact_trips"] = of_months(tables["fact_trips"], months)
    gate(run_model_tests(tables, model_tests()))
    publish(spark, layout.fact, change.folders)
    return stats


def refresh_late(spark: SparkSession, layout: Layout) -> list[datetime]:
    """Brings the fact up to all that was published in bronze since its months were built, without a load."""
    ensure_layers(spark, layout)
    upto = last_seq(log_of(spark, layout.bronze))
    months = fact_runs.stale_months(spark, layout.fact, layout.bronze)
    change = fact_runs.rebuild_run(spark, layout.fact, passed_bronze(spark, layout), months, upto)
    publish(spark, layout.fact, change.folders)
    return months


def check_bronze(bronze: DataFrame, max_rows: int | None = None, footers: DataFrame | None = None) -> DataFrame:
    """The bronze suite over all rows given; more than ``max_rows`` of them fail it. With ``footers``, the same
    rows read by ``sources.footers``, rules that counts decide read no column."""
    return run_rules(bronze, bronze_suite(max_rows), footers)


def tested_columns(table: str) -> list[str]:
    return list(dict.fromkeys(test.column for test in model_tests() if test.table == table))


def passed_periods(spark: SparkSession, layout: Layout) -> list[tuple[int, int]]:
    """Months that have passed: at most 12 per calendar year."""
    names = [name for name, entries in last_of(log_of(spark, layout.bronze)).items() if entries[0].folder is not None]
    return sorted(tuple(int(part.split("=")[1]) for part in name.split("/")) for name in names)


def passed_bronze(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_published(spark, layout.bronze, BRONZE, judged=True)


def judge_periods(
    spark: SparkSession,
    layout: Layout,
    periods: Sequence[tuple[int, int]],
    scope: str = "month",
    may_be_empty: bool = False,
) -> None:
    """Runs the bronze gate over the last deliveries of some months and publishes them if it passes; a
    backfill calls it too.

    With scope ``table`` they are judged together with all other months that passed before. An empty
    delivery withdraws its month; ``may_be_empty`` lets it pass.
    """
    waiting = deliveries(spark, layout.bronze, periods)
    judged = list(waiting)
    if scope == "table":
        named = {entry.partition for entry in waiting}
        judged += [e for name, entries in last_of(log_of(spark, layout.bronze)).items() if name not in named for e in entries]
    if not (may_be_empty and all(entry.folder is None for entry in waiting)):
        rows = read_folders(spark, layout.bronze, BRONZE, judged)
        gate(check_bronze(rows, footers=folder_footers(spark, layout.bronze, BRONZE, judged)))
    publish(spark, layout.bronze, [replace(entry, passed=True) for entry in waiting if not entry.passed])


def build_dimensions(spark: SparkSession, layout: Layout) -> None:
    """Writes the dimensions whose input has changed."""
    if write_changed(spark, read_zone_seed(spark, layout.zone_csv), layout.path("seeds.zones")) or not exists(
        spark, layout.path("gold.dim_zones")
    ):
        zones = stg_zones(spark.read.parquet(layout.path("seeds.zones")))
        overwrite_table(dim_zones(zones), layout.path("gold.dim_zones"))
    days = calendar(spark)
    stored = layout.path("gold.dim_datetime")
    if not exists(spark, stored) or fingerprint(days) != fingerprint(spark.read.schema(days.schema).parquet(stored)):
        overwrite_table(days, stored)


def fingerprint(rows: DataFrame) -> tuple:
    """Rows and their hashes, whatever their order; the audit time is left out."""
    names = [name for name in rows.columns if name != AUDIT]
    return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*names).cast("decimal(38,0)"))).first())


def write_changed(spark: SparkSession, rows: DataFrame, path: str) -> bool:
    """Full refresh, unless the table holds just these rows."""
    if exists(spark, path) and fingerprint(rows) == fingerprint(spark.read.schema(rows.schema).parquet(path)):
        return False
    overwrite_table(rows, path)
    return True


def built_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {
        "silver_trips": silver_trips(passed_bronze(spark, layout)),
        "silver_zones": stg_zones(spark.read.parquet(layout.path("seeds.zones"))),
        "fact_trips": read_fact(spark, layout.fact),
        "dim_zones": spark.read.parquet(layout.path("gold.dim_zones")),
        "dim_datetime": spark.read.parquet(layout.path("gold.dim_datetime")),
    }


def register_tables(spark: SparkSession, layout: Layout) -> None:
    """Puts the stored tables into the catalog, one database per layer, their partitions pointed at the
    published folders, and the silver layer into the session as views that are computed when they are read.
    Called again after a run, it moves the partitions that changed."""
    publish(spark, layout.fact, fact_runs.compact_run(spark, layout.fact).folders)
    point_catalog(spark, "bronze.trips", BRONZE, layout.bronze, BRONZE_PARTITIONS)
    point_catalog(spark, "gold.fact_trips", FACT, layout.fact, FACT_PARTITIONS)
    for name in ("seeds.zones", "gold.dim_zones", "gold.dim_datetime"):
        create_table(spark, name, spark.read.parquet(layout.path(name)).schema, layout.path(name))
    tables = built_tables(spark, layout)
    for name in ("silver_trips", "silver_zones"):
        tables[name].createOrReplaceTempView(name)
