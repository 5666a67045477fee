"""Counts that footers answer: same results as scans, and no column read."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tests.trips import at, bronze
from tripflow.contracts import BRONZE, BRONZE_PARTITIONS, RAW
from tripflow.operators.quality import between, not_null, row_count, run_rules
from tripflow.sinks.bronze import count_rows, delivered
from tripflow.sinks.published import ensure_published, publish, stage_run
from tripflow.sinks.tables import replace_partitions
from tripflow.sources.footers import PUSHED, filled_counts, folder_footers, footer_session, read_footers
from tripflow.sources.landing import bronze_manifest
from tripflow.sources.published import Folder
from tripflow.sources.tables import read_bronze

NAN = float("nan")
ROWS = [
    {},
    {"fare_amount": None, "tpep_pickup_datetime": None, "trip_distance": NAN},
    {"_month": 2, "tpep_pickup_datetime": at("2024-02-01"), "trip_distance": None},
    {"_month": 2, "PULocationID": None, "trip_distance": None},
]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("footers") / "bronze")
    replace_partitions(bronze(spark, *ROWS), path, BRONZE_PARTITIONS)
    return path


def pushed(frame) -> list[str]:
    return re.findall(r"PushedAggregation: \[(.+?)\]\n?", plan(frame))


def test_counts_of_partitions_equal_a_scan(spark, path):
    counts = filled_counts(read_footers(spark, path, BRONZE), BRONZE_PARTITIONS)
    scanned = filled_counts(read_bronze(spark, path), BRONZE_PARTITIONS)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, scanned.collect()))
    assert {row["_month"]: row["trip_distance"] for row in counts.collect()} == {1: 2, 2: 0}
    assert "COUNT(*)" in pushed(counts)[0] and "COUNT(trip_distance)" in pushed(counts)[0]
    assert not pushed(scanned)


def test_manifest_and_reconciliation_read_no_rows(spark, path):
    stored = read_footers(spark, path, BRONZE)
    names = sorted(row["_source_file"] for row in bronze_manifest(stored).collect())
    assert names == ["yellow_tripdata_2024-01.parquet", "yellow_tripdata_2024-02.parquet"]
    for frame in (bronze_manifest(stored), count_rows(stored, "rows"), count_rows(stored.filter("_month = 2"), "rows")):
        assert pushed(frame) == ["COUNT(*)"]
    assert [row["rows"] for row in count_rows(stored.filter("_month = 2"), "rows").collect()] == [2]


def test_rules_by_footers_equal_those_by_scan(spark, path):
    rules = [
        *[not_null(name) for name in RAW.names], not_null("absent"), between("trip_distance", 0, 100, 0.99),
        between("PULocationID", 500, 900), row_count(1), row_count(9),
    ]
    rows = read_bronze(spark, path)
    split = run_rules(rows, rules, read_footers(spark, path, BRONZE))
    assert sorted(map(str, split.collect())) == sorted(map(str, run_rules(rows, rules).collect()))
    text = plan(split)
    read = "".join(re.findall(r"ReadSchema: struct<(.*?)>", text))
    assert "trip_distance:" in read and "count(tpep_pickup_datetime):" in read
    assert "tpep_pickup_datetime:" not in read and "store_and_fwd_flag:" not in read
    only = run_rules(rows, [row_count(1)], read_footers(spark, path, BRONZE))
    assert [row["evaluated"] for row in only.collect()] == [4]


def test_published_tables(spark, tmp_path):
    path = str(tmp_path / "bronze")
    ensure_published(spark, path, BRONZE, BRONZE_PARTITIONS)
    assert filled_counts(read_footers(spark, path, BRONZE), BRONZE_PARTITIONS).count() == 0
    entries = [delivered(2024, month, "yellow", stage_run(bronze(spark, *rows), path, BRONZE_PARTITIONS))
               for month, rows in ((1, ROWS[:2]), (2, ROWS[2:]))]
    publish(spark, path, entries)
    counts = count_rows(read_footers(spark, path, BRONZE), "rows")
    assert {row["_month"]: row["rows"] for row in counts.collect()} == {1: 2, 2: 2}
    assert pushed(counts) == ["COUNT(*)"]
    assert not count_rows(read_footers(spark, path, BRONZE, judged=True), "rows").collect()


def test_replaced_files_are_left_out(spark, tmp_path):
    path = str(tmp_path / "bronze")
    run = stage_run(bronze(spark, *ROWS[:2]).repartition(1), path, BRONZE_PARTITIONS)
    folder = delivered(2024, 1, "yellow", run).folder
    file = next(name.name for name in (tmp_path / "bronze" / folder).iterdir() if name.suffix == ".parquet")
    entry = Folder("_year=2024/_month=1", folder, excluded=[f"{folder}/{file}"])
    assert not count_rows(folder_footers(spark, path, BRONZE, [entry]), "rows").collect()


def test_settings_of_the_caller_stay(spark):
    before = {key: spark.conf.get(key) for key in PUSHED}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        beside = footer_session(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert beside.conf.get("spark.sql.shuffle.partitions") == "3"
    assert {key: spark.conf.get(key) for key in PUSHED} == before
    assert spark.range(3).join(beside.range(2), "id").agg(F.count("id")).first()[0] == 2
