from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.test_dimensions import SEED
from tests.test_month import facts, month_of
from tests.trips import at, bronze, raw, write_month
from tripflow.contracts import AUDIT, BRONZE, BRONZE_PARTITIONS, FACT
from tripflow.operators.fact import fact_trips
from tripflow.operators.merge import delete_insert
from tripflow.operators.quality import QualityError
from tripflow.operators.silver import silver_trips
from tripflow.plans import month as month_plan
from tripflow.plans.month import Layout, ensure_layers, judge_periods, passed_bronze, refresh_late, register_tables, run_month
from tripflow.plans.star import fact_from_bronze
from tripflow.sinks import fact_runs
from tripflow.sinks.bronze import load_landing, load_month
from tripflow.sinks.fact import write_fact
from tripflow.sinks.published import drop_unused, ensure_published, point_catalog, publish, publish_all, stage_run, unused_runs
from tripflow.sinks.tables import replace_partitions
from tripflow.sources import published
from tripflow.sources.published import Folder, is_published, log_of, read_published
from tripflow.sources.tables import read_bronze, read_fact

FEBRUARY_SPILL = {"tpep_pickup_datetime": at("2024-01-31 23:50:00"), "tpep_dropoff_datetime": at("2024-02-01 00:10:00")}
FARE = 900.0


@pytest.fixture
def layout(tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text(SEED)
    return Layout(root=str(tmp_path / "lake"), landing=str(tmp_path / "raw"), zone_csv=str(csv))


def run(spark, layout, month, mode="rebuild"):
    return run_month(spark, layout, 2024, month, mode=mode)


def january(spark, layout) -> int:
    return read_fact(spark, layout.fact).filter("_source_file LIKE '%2024-01%'").count()


@pytest.fixture
def with_january(spark, layout):
    write_month(layout.landing, 2024, 1, month_of("2024-01-05"))
    run(spark, layout, 1)
    write_month(layout.landing, 2024, 2, [*month_of("2024-02-05"), raw(PULocationID=4, DOLocationID=132, **FEBRUARY_SPILL)])
    return layout


@pytest.mark.parametrize("event", ["missing", "failed", "backfill", "without a column"])
def test_a_bad_delivery_leaves_the_month_as_it_was(spark, with_january, tmp_path, event):
    layout = with_january
    file = tmp_path / "raw/yellow/yellow_tripdata_2024-01.parquet"
    if event == "missing":
        file.rename(tmp_path / "elsewhere.parquet")
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            run(spark, layout, 1)
    elif event == "without a column":
        import pyarrow.parquet as pq

        pq.write_table(pq.read_table(file).drop_columns(["tip_amount"]), file)
        with pytest.raises(ValueError, match="tip_amount"):
            run(spark, layout, 1)
    else:
        write_month(layout.landing, 2024, 1, month_of("2024-01-05", fare_amount=FARE))
        if event == "failed":
            with pytest.raises(QualityError, match="fare_amount"):
                run(spark, layout, 1)
        else:
            load_landing(spark, layout.bronze, f"{layout.landing}/yellow/*2024-01*")
    run(spark, layout, 2)  # touches January
    assert january(spark, layout) == 1200
    assert read_bronze(spark, layout.bronze).filter(f"_month = 1 AND fare_amount <> {FARE}").count() == 1200
    assert read_fact(spark, layout.fact).count() == 2401 and refresh_late(spark, layout) == []


def test_a_judged_backfill_becomes_the_month(spark, with_january):
    layout = with_january
    run(spark, layout, 2)
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 1300, tip_amount=2.0))
    load_landing(spark, layout.bronze, f"{layout.landing}/yellow/*2024-01*")
    assert passed_bronze(spark, layout).filter("_month = 1").count() == 1200
    judge_periods(spark, layout, [(2024, 1)])
    assert refresh_late(spark, layout) == [at("2024-01-01")]
    assert january(spark, layout) == 1300
    assert facts(read_fact(spark, layout.fact)) == facts(fact_from_bronze(read_bronze(spark, layout.bronze)))
    again = len(log_of(spark, layout.bronze))
    judge_periods(spark, layout, [(2024, 1)])
    assert len(log_of(spark, layout.bronze)) == again and refresh_late(spark, layout) == []


def test_a_fact_that_fails_its_tests_is_not_published(spark, with_january):
    layout = with_january
    write_month(layout.landing, 2024, 2, [*month_of("2024-02-05"), raw(PULocationID=999, **FEBRUARY_SPILL)])
    with pytest.raises(QualityError, match="relationships"):
        run(spark, layout, 2)
    assert read_fact(spark, layout.fact).count() == january(spark, layout) == 1200


def test_a_job_lost_before_publishing_leaves_the_old_month(spark, with_january, monkeypatch):
    layout = with_january
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 1300, tip_amount=2.0))
    before = facts(read_fact(spark, layout.fact))

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(month_plan, "publish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, layout, 1)
    assert facts(read_fact(spark, layout.fact)) == before
    assert read_bronze(spark, layout.bronze).count() == 1200
    monkeypatch.undo()
    run(spark, layout, 1)
    assert january(spark, layout) == 1300


def test_late_rows_are_found_without_naming_months(spark, layout):
    for month in (1, 2):
        write_month(layout.landing, 2024, month, month_of(f"2024-0{month}-05"))
        run(spark, layout, month, "append")
    late = [raw(PULocationID=4, DOLocationID=132, VendorID=9, **FEBRUARY_SPILL)]
    write_month(layout.landing, 2024, 3, [*month_of("2024-03-05"), *late])
    run(spark, layout, 3, "append")
    assert read_fact(spark, layout.fact).filter("vendor_id = 9").count() == 0
    assert at("2024-01-01") in refresh_late(spark, layout)
    assert facts(read_fact(spark, layout.fact)) == facts(fact_from_bronze(read_bronze(spark, layout.bronze)))
    assert refresh_late(spark, layout) == []
    write_month(layout.landing, 2024, 3, month_of("2024-03-05"))  # the late trip is withdrawn
    run(spark, layout, 3, "late")
    assert read_fact(spark, layout.fact).count() == 3600
    write_month(layout.landing, 2024, 2, [])
    run(spark, layout, 2, "late")
    assert facts(read_fact(spark, layout.fact)) == facts(fact_from_bronze(read_bronze(spark, layout.bronze)))
    assert read_fact(spark, layout.fact).count() == 2400


def test_months_of_a_file_come_from_the_log(spark, with_january, monkeypatch):
    layout = with_january
    run(spark, layout, 2)

    def read(*_, **__):
        raise AssertionError("the fact is read")

    monkeypatch.setattr(fact_runs, "read_folders", read)
    monkeypatch.setattr(published, "read_folders", read)
    log = log_of(spark, layout.fact)
    assert fact_runs.months_from(log, ["yellow_tripdata_2024-02.parquet"]) == [at("2024-01-01"), at("2024-02-01")]
    assert fact_runs.months_from(log, ["yellow_tripdata_2023-02.parquet"]) == []


def fact(spark, *rows):
    return fact_trips(silver_trips(bronze(spark, *rows)))


def trips(month: int, first: int, n: int, **values) -> list[dict]:
    return [
        {"VendorID": first + k, "tpep_pickup_datetime": at(f"2024-0{month}-10 10:00:00"),
         "tpep_dropoff_datetime": at(f"2024-0{month}-10 10:30:00")} | values
        for k in range(n)
    ]


def no_audit(frame):
    return sorted(map(str, frame.drop(AUDIT).collect()))


def files_of(spark, path) -> set[str]:
    return set(read_fact(spark, path).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_upsert_writes_only_files_with_a_replaced_key(spark, tmp_path):
    path = str(tmp_path / "fact")
    ensure_published(spark, path, FACT, ["pickup_month"])
    for first, month in ((0, 1), (100, 1), (200, 1), (0, 2)):  # January lies in three folders
        change = fact_runs.upsert_run(spark, path, fact(spark, *trips(month, first, 20)))
        publish(spark, path, change.folders)
    before, expected = files_of(spark, path), read_fact(spark, path)
    everything = fact(spark, *trips(1, 0, 20), *trips(1, 100, 20), *trips(1, 200, 20), *trips(2, 0, 20))
    assert no_audit(expected) == no_audit(everything)
    batch = fact(spark, *trips(1, 105, 3, tip_amount=9.0), *trips(1, 300, 2), *trips(3, 0, 1))
    wanted = no_audit(delete_insert(everything.drop(AUDIT), batch.drop(AUDIT), ["trip_id"]))
    for _ in range(2):
        publish(spark, path, fact_runs.upsert_run(spark, path, batch).folders)
        assert no_audit(read_fact(spark, path)) == wanted
    after = files_of(spark, path)
    untouched = {name for name in before if name in after}
    assert len(before) - len(untouched) == 1 and len(untouched) == 3
    with pytest.raises(ValueError, match="compact"):
        point_catalog(spark, "gold_u.fact", FACT, path, ["pickup_month"])
    publish(spark, path, fact_runs.compact_run(spark, path).folders)
    assert no_audit(read_fact(spark, path)) == wanted and fact_runs.compact_run(spark, path).folders == []
    assert len(unused_runs(spark, path)) > 0 and drop_unused(spark, path) and unused_runs(spark, path) == []
    assert no_audit(read_fact(spark, path)) == wanted
    point_catalog(spark, "gold_u.fact", FACT, path, ["pickup_month"])
    assert no_audit(spark.table("gold_u.fact").select(*FACT.names)) == wanted


def test_upsert_reads_keys_and_file_names_of_the_stored_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    ensure_published(spark, path, FACT, ["pickup_month"])
    publish_all(spark, path, fact_runs.staged(fact(spark, *trips(1, 0, 5), *trips(2, 0, 5)), path).values())
    held = published.read_folders(spark, path, FACT, published.readable(log_of(spark, path), True), with_place=True)
    plan = held.select("trip_id", "_place")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<trip_id:string>" in plan


def test_trips_without_a_month_and_an_adopted_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    undated = {name: F.lit(None).cast("timestamp_ntz") for name in ("pickup_datetime", "pickup_month")}
    stored = fact(spark, *trips(1, 0, 3)).unionByName(fact(spark, *trips(1, 7, 1)).withColumns(undated).select(*FACT.names))
    write_fact(stored, path)  # plain folders, no log
    ensure_published(spark, path, FACT, ["pickup_month"])
    assert is_published(spark, path) and no_audit(read_fact(spark, path)) == no_audit(stored)
    batch = fact(spark, *trips(1, 1, 1, tip_amount=9.0)).unionByName(fact(spark, *trips(1, 9, 1)).withColumns(undated).select(*FACT.names))
    for _ in range(2):
        publish(spark, path, fact_runs.upsert_run(spark, path, batch).folders)
        found = {row["vendor_id"]: row["tip_amount"] for row in read_fact(spark, path).collect()}
        assert found == {0: 5.0, 1: 9.0, 2: 5.0, 7: 5.0, 9: 5.0} and read_fact(spark, path).count() == 5
    publish_all(spark, path, fact_runs.staged(fact(spark, *trips(5, 0, 2)), path).values())
    assert read_fact(spark, path).select("pickup_month").distinct().first()[0] == at("2024-05-01")


def test_a_publication_changes_all_its_months_or_none(spark, tmp_path):
    path = str(tmp_path / "bronze")
    replace_partitions(bronze(spark, {}, {"_month": 2}), path, BRONZE_PARTITIONS)
    ensure_published(spark, path, BRONZE, BRONZE_PARTITIONS)
    old = sorted(map(str, read_bronze(spark, path).collect()))
    name = "_year=2024/_month={}".format
    new = stage_run(bronze(spark, {"VendorID": 8}, {"VendorID": 8, "_month": 2}), path, BRONZE_PARTITIONS)
    assert sorted(map(str, read_bronze(spark, path).collect())) == old
    point_catalog(spark, "bronze_p.trips", BRONZE, path, BRONZE_PARTITIONS)
    publish(spark, path, [Folder(name(month), f"{new}/{name(month)}") for month in (1, 2)])
    assert sorted(row["VendorID"] for row in read_bronze(spark, path).collect()) == [8, 8]
    assert {row["VendorID"] for row in spark.table("bronze_p.trips").collect()} == {1}
    point_catalog(spark, "bronze_p.trips", BRONZE, path, BRONZE_PARTITIONS)
    assert {row["VendorID"] for row in spark.table("bronze_p.trips").collect()} == {8}
    publish(spark, path, [Folder(name(1), None)])
    point_catalog(spark, "bronze_p.trips", BRONZE, path, BRONZE_PARTITIONS)
    assert [row["_month"] for row in spark.table("bronze_p.trips").collect()] == [2]
    assert read_bronze(spark, path).columns == BRONZE.names


def test_deliveries_of_a_published_table_wait_to_be_judged(spark, layout):
    ensure_layers(spark, layout)
    write_month(layout.landing, 2024, 1, month_of("2024-01-05", 1100))
    stats = load_month(spark, layout.landing, layout.bronze, 2024, 1)
    assert stats.reconciled and stats.output_count == 1100
    assert read_bronze(spark, layout.bronze).count() == 1100  # never passed yet: the last delivery shows
    assert passed_bronze(spark, layout).count() == 0
    counts = load_landing(spark, layout.bronze, f"{layout.landing}/yellow").collect()
    assert [(row["month"], row["input_count"], row["difference"]) for row in counts] == [(1, 1100, 0)]
    judge_periods(spark, layout, [(2024, 1)])
    assert passed_bronze(spark, layout).count() == 1100
    with pytest.raises(QualityError):
        judge_periods(spark, layout, [(2024, 7)])
    assert read_published(spark, layout.bronze, BRONZE, judged=True).columns == BRONZE.names


def test_catalog_follows_a_later_run(spark, with_january):
    layout = with_january
    for month, rows in ((1, 1200), (2, 2401)):
        run(spark, layout, month)
        register_tables(spark, layout)
        assert spark.table("gold.fact_trips").count() == rows
    spark.sql("DROP TABLE gold.fact_trips")
    spark.sql("DROP TABLE bronze.trips")


def test_dimensions_are_written_when_their_input_changes(spark, with_january, tmp_path):
    layout = with_january
    stamp = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "lake/gold/dim_datetime").glob("*.parquet")}
    zones = lambda: spark.read.parquet(layout.path("gold.dim_zones")).count()
    before, n = stamp(), zones()
    (tmp_path / "zones.csv").write_text(SEED + "999,Queens,Somewhere New,Boro Zone\n")
    run(spark, layout, 2)
    assert stamp() == before and zones() == n + 1
