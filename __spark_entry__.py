
from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from tripflow import fixtures
from tripflow.contracts import (
    AUDIT,
    BRONZE,
    BRONZE_PARTITIONS,
    FACT_PARTITIONS,
    RAW,
    PAYMENT_TYPES,
    TIE_BREAK,
    TRIP_KEY,
)
from tripflow.functions import surrogate_key
from tripflow.operators.dimensions import (
    date_spine,
    day_bounds,
    dim_datetime,
    dim_zones,
    stg_zones,
)
from tripflow.operators.fact import fact_trips, later_than
from tripflow.operators.lookup import with_calendar, with_zones
from tripflow.operators.merge import delete_insert
from tripflow.operators.quality import (
    QualityError,
    duplicate_keys,
    failing_values,
    orphan_values,
    run_model_tests,
    run_rules,
    summarize,
    top_failing_values,
    unaccepted_values,
)
from tripflow.operators.sample import sample_rows
from tripflow.operators.silver import keep_latest, rename_trips, silver_trips, valid_trips
from tripflow.periods import target_periods
from tripflow.plans import marts, suites
from tripflow.plans.month import Layout, ensure_layers, refresh_late, run_month, tested_columns
from tripflow.plans.star import FACT_VALUES, fact_from_bronze
from tripflow.session import scratch_path, stage
from tripflow.sinks import fact_runs
from tripflow.sinks.bronze import load_landing, load_month
from tripflow.sinks.bucketed import buckets_of, read_bucketed, upsert_bucketed, write_bucketed
from tripflow.sinks.fact import (
    append_new_trips,
    rebuild_months,
    touched_months,
    upsert_fact,
    write_fact,
)
from tripflow.sinks.published import publish, publish_all
from tripflow.sinks.tables import CODEC, create_table, overwrite_table
from tripflow.sources.footers import filled_counts, read_footers
from tripflow.sources.landing import audit_landing, bronze_manifest, landing_path, read_landing
from tripflow.sources.seeds import read_zone_seed
from tripflow.sources.tables import bronze_view, read_bronze, read_fact

try:  # absent when only the reference's own operators are wanted
    import corpus_pipeline
    from tripflow.llm import registry as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tripflow.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

ENTRY_DIR = "/root/testdata/sf0.001"
FIRST_LOAD, SECOND_LOAD = "2026-01-01 00:00:00", "2026-01-02 00:00:00"
SPLIT_DAY = "1998-01-01"
RELOADED_YEAR = 1997


def entry(spark: SparkSession) -> DataFrame:
    return monthly_revenue(spark, ENTRY_DIR)


# Inputs


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_trips(spark, sf_dir)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(stg_zones(fixtures.zone_seed(spark, sf_dir))).drop(AUDIT)


def fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return fact_from_bronze(bronze(spark, sf_dir), columns or FACT_VALUES)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the days that occur in the valid trips."""
    return dim_datetime(hours_of_trips(spark, sf_dir)).drop(AUDIT)


def hours_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = valid_trips(rename_trips(fixtures.bronze_trips(spark, sf_dir, (1,))))
    return date_spine(day_bounds(trips, "pickup_datetime"))


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Writes the trips as raw months to the shared folder; returns the path to scan."""
    path = scratch_path(spark, "landing")
    name = F.concat(
        F.lit("yellow_tripdata_"), F.date_format("l_shipdate", "yyyy-MM"), F.lit(".parquet")
    )
    raw = fixtures.raw_trips(spark, sf_dir)
    (
        raw.withColumn("file", name)
        .drop("l_shipdate")
        .hint("rebalance", "file")
        .write.partitionBy("file")
        .parquet(path)
    )
    return path


def loaded_bronze(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "bronze")
    load_landing(spark, path, landing(spark, sf_dir), ingested_at=FIRST_LOAD)
    return path


def stored_fact(spark: SparkSession, facts: DataFrame) -> str:
    path = scratch_path(spark, "fact")
    write_fact(facts, path, by_time=True)
    return path


# Bronze


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, landing(spark, sf_dir), ingested_at=FIRST_LOAD)


def bronze_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads all months, then one year again: its months are replaced, the others stay."""
    files, path = landing(spark, sf_dir), scratch_path(spark, "bronze")
    load_landing(spark, path, files, ingested_at=FIRST_LOAD)
    load_landing(
        spark, path, f"{files}/file=yellow_tripdata_{RELOADED_YEAR}-*", ingested_at=SECOND_LOAD
    )
    return (
        read_bronze(spark, path)
        .groupBy(*BRONZE_PARTITIONS)
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.min("_ingested_at").alias("first_stamp"),
            F.max("_ingested_at").alias("last_stamp"),
            F.round(F.sum("total_amount"), 2).alias("total_amount"),
        )
    )


def bronze_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    return load_landing(spark, path, landing(spark, sf_dir), ingested_at=FIRST_LOAD)


def bronze_table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze_view(spark, loaded_bronze(spark, sf_dir), "trips_bronze")
    return spark.sql("SELECT _year, _month, count(*) AS trips FROM trips_bronze GROUP BY ALL")


def bronze_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and non-null values of every raw column by month, from the footers of the stored files."""
    stored = read_footers(spark, loaded_bronze(spark, sf_dir), BRONZE)
    return filled_counts(stored, BRONZE_PARTITIONS, RAW.names)


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["VendorID", "tpep_pickup_datetime", "total_amount"]
    view = bronze_view(spark, loaded_bronze(spark, sf_dir), "trips_bronze")
    return view.select(*columns).orderBy(*columns).limit(5)


def bronze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a capped sample, and how many of its rows are found in the table."""
    cap = 10_000
    trips = read_bronze(spark, loaded_bronze(spark, sf_dir))
    drawn = sample_rows(trips, cap, seed=7)
    key = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount"]
    found = drawn.join(trips.select(*key).distinct().withColumn("found", F.lit(1)), key, "left")
    return found.agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count("found").alias("found"),
    )


def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the months delivered or ordered in, against a bronze that holds one year."""
    files, path = landing(spark, sf_dir), scratch_path(spark, "bronze")
    load_landing(spark, path, f"{files}/file=yellow_tripdata_{RELOADED_YEAR}-*")
    ordered = F.date_format("o_orderdate", "yyyy-MM")
    expected = fixtures.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("yellow_tripdata_"), ordered, F.lit(".parquet")).alias("_source_file")
    )
    audit = audit_landing(
        spark, files, loaded=bronze_manifest(read_footers(spark, path, BRONZE)), expected=expected, min_bytes=1_000
    )
    return audit.drop("bytes")


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv, table = scratch_path(spark, "zones-csv"), scratch_path(spark, "zones")
    fixtures.zone_seed(spark, sf_dir).write.option("header", "true").csv(csv)
    overwrite_table(read_zone_seed(spark, csv), table)
    return spark.read.parquet(table)


def target_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand in for runs; their dates precede the usual first year."""
    orders = fixtures.table(spark, sf_dir, "orders")
    return target_periods(orders, "o_orderdate", first_year=1995)


# Silver


def silver_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trips(rename_trips(bronze(spark, sf_dir)))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(rename_trips(bronze(spark, sf_dir)), TRIP_KEY, "_ingested_at", TIE_BREAK)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = rename_trips(bronze(spark, sf_dir))
    return trips.select(surrogate_key(*TRIP_KEY).alias("trip_id"), *TRIP_KEY)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_trips(bronze(spark, sf_dir))


def staged_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_zones(fixtures.zone_seed(spark, sf_dir))


# Gold


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run adds when the stored fact ends before the split day."""
    facts = fact(spark, sf_dir, "trip_id", "pickup_datetime")
    stored = facts.filter(F.col("pickup_datetime") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    mark = stored.agg(F.max("pickup_datetime")).scalar()
    return fact_trips(later_than(silver(spark, sf_dir), mark), FACT_VALUES)


def fact_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run against stored tables, twice: the second run adds nothing."""
    trips = silver_trips(bronze(spark, sf_dir), by_time=True)
    early = trips.filter(F.col("pickup_datetime") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    path = stored_fact(spark, fact_trips(early))
    append_new_trips(spark, path, trips, by_time=True)
    append_new_trips(spark, path, trips, by_time=True)
    return read_fact(spark, path).drop(AUDIT)


def batch_facts(spark: SparkSession, sf_dir: str, batch: int, by_time: bool = False) -> DataFrame:
    return fact_trips(silver_trips(fixtures.bronze_trips(spark, sf_dir, (batch,)), by_time=by_time))


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (batch_facts(spark, sf_dir, batch).drop(AUDIT) for batch in (1, 2))
    return delete_insert(first, second, ["trip_id"])


def fact_upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_fact(spark, batch_facts(spark, sf_dir, 1, by_time=True))
    upsert_fact(spark, path, batch_facts(spark, sf_dir, 2))
    return read_fact(spark, path).drop(AUDIT)


def fact_upsert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert on a published table, where only files with a replaced key are written again."""
    layout = Layout(root=scratch_path(spark, "lake"), landing="", zone_csv="")
    ensure_layers(spark, layout)
    first, second = batch_facts(spark, sf_dir, 1, by_time=True), batch_facts(spark, sf_dir, 2)
    publish_all(spark, layout.fact, fact_runs.staged(first, layout.fact, by_time=True).values())
    publish(spark, layout.fact, fact_runs.upsert_run(spark, layout.fact, second).folders)
    return read_fact(spark, layout.fact).drop(AUDIT)


def fact_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert on a table bucketed by key, where the stored side is not exchanged."""
    name = f"gold_{uuid.uuid4().hex[:8]}.fact_by_key"
    buckets = buckets_of(fixtures.order_lines(spark, sf_dir).count())
    first = silver_trips(fixtures.bronze_trips(spark, sf_dir, (1,)), buckets=buckets)
    write_bucketed(fact_trips(first), name, buckets, dealt=True)
    upsert_bucketed(spark, name, batch_facts(spark, sf_dir, 2))
    return read_bucketed(spark, name).drop(AUDIT)


def fact_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact of the first delivery, brought up to date for one reloaded year."""
    path = stored_fact(spark, batch_facts(spark, sf_dir, 1, by_time=True))
    trips = bronze(spark, sf_dir)
    reloaded = trips.filter(F.col("_year") == RELOADED_YEAR)
    newer = reloaded.filter(F.col("_ingested_at") == F.lit(SECOND_LOAD).cast("timestamp_ntz"))
    rebuild_months(spark, path, trips, touched_months(spark, newer, path))
    return (
        read_fact(spark, path)
        .groupBy(*FACT_PARTITIONS, "_source_file")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.round(F.sum("tip_amount"), 2).alias("tip_amount"),
        )
    )


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, "trip_id", "trip_duration_minutes")


def fact_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, "trip_id", "fare_per_mile", "tip_percentage")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hours_of_trips(spark, sf_dir).withColumn("date_day", F.col("date_day").cast("string"))


def calendar_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(spark, sf_dir).withColumn("date_day", F.col("date_day").cast("string"))


# Serving


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = marts.kpi_summary(fact(spark, sf_dir, "total_amount", "trip_distance"))
    return kpis.select(
        F.round("total_revenue", 2).alias("total_revenue"),
        "total_trips",
        F.round("revenue_per_mile", 6).alias("revenue_per_mile"),
    )


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = marts.monthly_revenue(fact(spark, sf_dir, "pickup_month", "total_amount"))
    return trend.withColumn("revenue", F.round("revenue", 2))


def trips_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trips_by_zone(fact(spark, sf_dir, "pickup_location_id"), zones(spark, sf_dir))


def top_pickup_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_pickup_zones(fact(spark, sf_dir, "pickup_location_id"), zones(spark, sf_dir))


def trips_between_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact(spark, sf_dir, "pickup_location_id", "dropoff_location_id")
    return marts.trips_between_boroughs(facts, zones(spark, sf_dir))


def fact_with_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact(spark, sf_dir, "trip_id", "pickup_location_id", "dropoff_location_id")
    return with_zones(facts, zones(spark, sf_dir))


def fact_with_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact(spark, sf_dir, "trip_id", "pickup_datetime")
    return with_calendar(facts, calendar(spark, sf_dir))


def hourly_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_heatmap(fact(spark, sf_dir, "pickup_day_of_week", "pickup_hour"))


def heatmap_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.heatmap_grid(fact(spark, sf_dir, "pickup_day_of_week", "pickup_hour"))


def trips_by_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact(spark, sf_dir, "pickup_datetime", "total_amount")
    parts = marts.trips_by_daypart(facts, calendar(spark, sf_dir))
    return parts.withColumn("revenue", F.round("revenue", 2))


# Quality


def dq_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rules(bronze(spark, sf_dir), suites.bronze_columns())


def dq_bronze_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rules(bronze(spark, sf_dir), suites.bronze_values())


def dq_stored_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite on the stored first delivery: footers decide what counts decide, a scan the rest."""
    path = loaded_bronze(spark, sf_dir)
    return run_rules(read_bronze(spark, path), suites.bronze_values(), read_footers(spark, path, BRONZE))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict a gate acts on, over the whole bronze suite."""
    return summarize(run_rules(bronze(spark, sf_dir), suites.bronze_suite()))


def built_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    match name:
        case "silver_trips":
            return silver_trips(bronze(spark, sf_dir), columns=columns)
        case "silver_zones":
            return staged_zones(spark, sf_dir)
        case "fact_trips":
            return fact(spark, sf_dir, *columns)
        case "dim_zones":
            return zones(spark, sf_dir)
        case _:
            return calendar(spark, sf_dir)


def model_checks(check: str) -> Query:
    """All tests of one kind, over tables that carry just the tested columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tests = [test for test in suites.model_tests() if test.check == check]
        columns: dict[str, list[str]] = {}
        for test in tests:
            columns.setdefault(test.table, []).append(test.column)
            if test.parent:
                columns.setdefault(test.parent, []).append(test.key)
        tables = {name: built_table(spark, sf_dir, name, own) for name, own in columns.items()}
        return run_model_tests(tables, tests)

    return query


def dq_unaccepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unaccepted_values(fact(spark, sf_dir, "payment_type"), "payment_type", PAYMENT_TYPES)


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips delivered more than once, found by their key before deduplication."""
    return duplicate_keys(surrogate_keys(spark, sf_dir), "trip_id")


def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing values of the range and set rules with their share, and orphan zones."""
    trips = bronze(spark, sf_dir)
    failing = failing_values(trips, suites.bronze_values())
    orphans = orphan_values(
        fact(spark, sf_dir, "pickup_location_id", "dropoff_location_id"),
        ["pickup_location_id", "dropoff_location_id"],
        zones(spark, sf_dir),
        "zone_id",
    )
    return failing.withColumn("share", F.round("share", 9)).unionByName(
        orphans.select(
            F.lit("relationships").alias("check"),
            "column",
            F.col("value").cast("double").alias("value"),
            "rows",
            F.lit(None).cast("double").alias("share"),
        )
    )


def dq_top_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent failing values of every range and set rule."""
    top = top_failing_values(bronze(spark, sf_dir), suites.bronze_values(), 5)
    return top.withColumn("share", F.round("share", 9))


def dq_model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tests of all built tables, one scan a table."""
    columns = {"silver_trips": tested_columns("silver_trips"), "fact_trips": tested_columns("fact_trips")}
    names = dict.fromkeys(test.table for test in suites.model_tests())
    tables = {name: built_table(spark, sf_dir, name, columns.get(name, [])) for name in names}
    return run_model_tests(tables, suites.model_tests())


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-count rule with an upper bound that the table keeps, and one that it breaks."""
    rules = [suites.row_count(1000, 10**12), suites.row_count(1000, 1001)]
    return run_rules(bronze(spark, sf_dir), rules)


# Months of the run


def deliveries(spark: SparkSession, sf_dir: str) -> Layout:
    """All trips, shaped to pass the checks, as three monthly deliveries; the second has wrong fares."""
    root = scratch_path(spark, "lake")
    trips = fixtures.clean_raw_trips(spark, sf_dir)
    for month, condition in fixtures.DELIVERY_MONTHS.items():
        write_delivery(trips.filter(condition), f"{root}/raw", month, fare=900.0 if month == 2 else None)
    csv = f"{root}/zones"
    fixtures.zone_seed(spark, sf_dir).coalesce(1).write.option("header", "true").csv(csv)
    return Layout(root=f"{root}/tables", landing=f"{root}/raw", zone_csv=csv)


def write_delivery(trips: DataFrame, landing_root: str, month: int, fare: float | None = None) -> None:
    if fare is not None:
        trips = trips.withColumn("fare_amount", F.lit(fare))
    trips.write.mode("overwrite").option("compression", CODEC).parquet(landing_path(landing_root, 2024, month))


def month_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good, a bad and a good month, then the bad one corrected: what the fact holds after each phase."""
    layout = deliveries(spark, sf_dir)
    for month in (1, 2, 3):
        try:
            run_month(spark, layout, 2024, month, mode="rebuild", ingested_at=FIRST_LOAD)
        except QualityError:
            if month != 2:
                raise
    first = stage(fact_summary(spark, layout, "without"), "month-run")
    trips = fixtures.clean_raw_trips(spark, sf_dir).filter(fixtures.DELIVERY_MONTHS[2])
    write_delivery(trips, layout.landing, 2)
    run_month(spark, layout, 2024, 2, mode="rebuild", ingested_at=SECOND_LOAD)
    return first.union(fact_summary(spark, layout, "with"))


def mixed_deliveries(spark: SparkSession, sf_dir: str) -> tuple[Layout, DataFrame]:
    """All trips as three deliveries that have trips of all pickup months each; and the trips with their delivery."""
    root = scratch_path(spark, "lake")
    trips = fixtures.clean_raw_trips(spark, sf_dir).withColumn("delivery", F.expr(fixtures.MIXED))
    for month in (1, 2, 3):
        write_delivery(trips.filter(F.col("delivery") == month).drop("delivery"), f"{root}/raw", month)
    csv = f"{root}/zones"
    fixtures.zone_seed(spark, sf_dir).coalesce(1).write.option("header", "true").csv(csv)
    return Layout(root=f"{root}/tables", landing=f"{root}/raw", zone_csv=csv), trips


def month_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good month and a bad one, then deliveries that must not touch the first: one is missing, one fails its
    gate, a backfill is never judged. A good month that shares all pickup months with it is rebuilt after each."""
    layout, trips = mixed_deliveries(spark, sf_dir)
    missing, bad = (replace(layout, landing=f"{layout.landing}-{name}") for name in ("missing", "bad"))
    for month in (1, 2):
        write_delivery(trips.filter(F.col("delivery") == month).drop("delivery"), bad.landing, month, fare=900.0)
    run = lambda month, where: run_month(spark, where, 2024, month, mode="rebuild", ingested_at=FIRST_LOAD)
    run(1, layout)
    refused = 0
    for month, where in ((2, bad), (1, missing), (1, bad)):
        try:
            run(month, where)
        except (QualityError, AnalysisException):
            refused += 1
    load_landing(spark, layout.bronze, f"{bad.landing}/yellow", ingested_at=SECOND_LOAD)
    run(3, layout)
    refresh_late(spark, layout)
    return fact_summary(spark, layout, f"refused {refused}")


def fact_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose trips mostly come behind the mark are appended; then the months that got rows since they
    were built are found and rebuilt."""
    layout, _ = mixed_deliveries(spark, sf_dir)
    for month in (1, 2, 3):
        run_month(spark, layout, 2024, month, ingested_at=FIRST_LOAD)
    refresh_late(spark, layout)
    return read_fact(spark, layout.fact).drop(AUDIT)


def fact_summary(spark: SparkSession, layout: Layout, phase: str) -> DataFrame:
    """Trips and fares by delivery and month; fares are added as decimals, so their order does not matter."""
    fares = F.sum(F.col("fare_amount").cast("decimal(24,9)")).cast("double")
    return (
        read_fact(spark, layout.fact)
        .groupBy(F.lit(phase).alias("phase"), "_source_file", "pickup_month")
        .agg(F.count(F.lit(1)).alias("trips"), fares.alias("fares"))
    )


def bronze_load_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of loading three deliveries one by one, and the last of them again."""
    layout = deliveries(spark, sf_dir)
    loads = [load_month(spark, layout.landing, layout.bronze, 2024, month) for month in (1, 2, 3, 3)]
    frames = [load.to_frame(spark).drop("duration_seconds") for load in loads]
    return reduce(DataFrame.union, frames).withColumn(
        "stored", F.lit(read_bronze(spark, layout.bronze).count())
    )


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the catalog's bronze table by month, over files loaded beforehand."""
    path, name = loaded_bronze(spark, sf_dir), f"bronze_{uuid.uuid4().hex[:8]}.trips"
    create_table(spark, name, BRONZE, path, BRONZE_PARTITIONS)
    return spark.table(name).groupBy(*BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("trips"))


def bronze_load_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of deliveries whose column types differ from file to file."""
    root = scratch_path(spark, "drift")
    trips = fixtures.clean_raw_trips(spark, sf_dir)
    for month, condition in fixtures.DELIVERY_MONTHS.items():
        part = trips.filter(condition)
        if month == 2:
            part = part.withColumn("passenger_count", F.col("passenger_count").cast("double"))
            part = part.withColumn("VendorID", F.col("VendorID").cast("long"))
        write_delivery(part, root, month)
    load_landing(spark, f"{root}/bronze", f"{root}/yellow", ingested_at=FIRST_LOAD)
    return read_bronze(spark, f"{root}/bronze")


def queries() -> dict[str, Query]:
    return reference_queries() | (llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements() | (llm.SQL if llm else {})
    if llm and corpus_pipeline.ORACLE_SQL:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements


def reference_queries() -> dict[str, Query]:
    return {
        "bronze_load": bronze_load,
        "bronze_write": bronze_write,
        "bronze_reconcile": bronze_reconcile,
        "bronze_filled": bronze_filled,
        "bronze_view": bronze_table_view,
        "bronze_preview": bronze_preview,
        "bronze_sample": bronze_sample,
        "landing_audit": landing_audit,
        "zone_seed": zone_seed,
        "target_period": target_period,
        "silver_filter": silver_filter,
        "silver_dedup": silver_dedup,
        "surrogate_key": surrogate_keys,
        "silver_trips": silver,
        "stg_zones": staged_zones,
        "fact_trips": fact,
        "fact_incremental": fact_incremental,
        "fact_append": fact_append,
        "fact_upsert": fact_upsert,
        "fact_upsert_stored": fact_upsert_stored,
        "fact_upsert_files": fact_upsert_files,
        "fact_upsert_bucketed": fact_upsert_bucketed,
        "fact_rebuild": fact_rebuild,
        "trip_duration": trip_duration,
        "fact_ratios": fact_ratios,
        "date_spine": spine,
        "dim_datetime": calendar_dimension,
        "dim_zones": zones,
        "kpi_summary": kpi_summary,
        "monthly_revenue": monthly_revenue,
        "trips_by_zone": trips_by_zone,
        "top_pickup_zones": top_pickup_zones,
        "trips_between_boroughs": trips_between_boroughs,
        "fact_with_zones": fact_with_zones,
        "fact_with_calendar": fact_with_calendar,
        "hourly_heatmap": hourly_heatmap,
        "heatmap_grid": heatmap_grid,
        "trips_by_daypart": trips_by_daypart,
        "dq_columns": dq_columns,
        "dq_bronze_suite": dq_bronze_suite,
        "dq_stored_suite": dq_stored_suite,
        "dq_gate": dq_gate,
        "dq_not_null": model_checks("not_null"),
        "dq_unique": model_checks("unique"),
        "dq_accepted_values": model_checks("accepted_values"),
        "dq_relationships": model_checks("relationships"),
        "dq_unaccepted_values": dq_unaccepted_values,
        "dq_duplicate_keys": dq_duplicate_keys,
        "dq_failures": dq_failures,
        "dq_row_count": dq_row_count,
        "dq_top_failures": dq_top_failures,
        "dq_model_tests": dq_model_tests,
        "month_run": month_run,
        "month_redelivery": month_redelivery,
        "fact_late_rows": fact_late_rows,
        "bronze_load_month": bronze_load_month,
        "bronze_load_drift": bronze_load_drift,
        "catalog_tables": catalog_tables,
    }
