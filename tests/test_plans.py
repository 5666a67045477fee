"""The plans that make the work scale: pruning, pushdown, shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.trips import at, bronze
from tripflow.contracts import BRONZE_PARTITIONS, FACT, FACT_PARTITIONS
from tripflow.operators.dimensions import calendar
from tripflow.operators.fact import fact_trips, later_than
from tripflow.operators.silver import silver_trips
from tripflow.plans import marts
from tripflow.plans.star import fact_from_bronze
from tripflow.sinks.fact import of_months, picked_up_in, write_fact
from tripflow.sinks.tables import replace_partitions
from tripflow.sources.tables import latest_pickup, read_bronze, read_fact


def plan(frame) -> str:
    query = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(query, "formatted")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    rows = bronze(spark, {}, {"_month": 2, "tpep_pickup_datetime": at("2024-02-01")})
    replace_partitions(rows, path, BRONZE_PARTITIONS)
    return read_bronze(spark, path)


@pytest.fixture(scope="module")
def fact_path(spark, stored, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "fact")
    write_fact(fact_trips(silver_trips(stored)), path)
    return path


def test_dedup_cuts_copies_before_its_only_shuffle(stored):
    text = plan(silver_trips(stored))
    tree = text[: text.index("(1)")]
    assert tree.count("Exchange") == 1
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")  # deeper in the tree


def test_silver_scan_prunes_partitions_columns_and_rows(stored):
    text = plan(silver_trips(stored, periods=[(2024, 1)], columns=["trip_id", "fare_amount"]))
    assert re.search(r"PartitionFilters: .*_year#\d+ = 2024.*_month#\d+ = 1", text)
    assert "GreaterThanOrEqual(trip_distance,0.0)" in text
    assert "LessThanOrEqual(total_amount,2000.0)" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    read = {field.split(":")[0] for field in schema.split(",")}
    assert "payment_type" not in read and "_source_file" not in read
    assert "fare_amount" in read and "DOLocationID" in read


def test_mark_reaches_the_bronze_scan(stored):
    mark = F.lit("2024-01-20 10:00:00").cast("timestamp_ntz")
    assert "GreaterThan(tpep_pickup_datetime,2024-01-20T10:00)" in plan(
        later_than(silver_trips(stored), mark)
    )


def test_rebuild_ranges_reach_the_bronze_scan(stored):
    text = plan(silver_trips(picked_up_in(stored, [at("2023-12-01"), at("2024-01-01")])))
    assert "LessThan(tpep_pickup_datetime,2024-02-01T00:00)" in text
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2023-12-01T00:00)" in text


def test_stored_fact_is_pruned_by_month(spark, fact_path):
    text = plan(of_months(read_fact(spark, fact_path), [at("2024-01-01")]))
    assert re.search(r"PartitionFilters: .*pickup_month#\d+ = 2024-01-01 00:00:00", text)
    newest = plan(latest_pickup(read_fact(spark, fact_path)))
    assert re.search(r"PartitionFilters: .*pickup_month#\d+ = Subquery", newest)
    assert "ReadSchema: struct<pickup_datetime:timestamp_ntz>" in newest


def test_marts_count_before_they_join(spark, stored):
    zones = spark.createDataFrame(
        [(10, "A", "B", "Queens", False)],
        "zone_id int, zone_name string, borough string, borough_group string, is_airport boolean",
    )
    facts = fact_from_bronze(stored, ["pickup_location_id", "dropoff_location_id", "pickup_datetime", "total_amount"])
    for mart in (
        marts.trips_by_zone(facts, zones),
        marts.trips_between_boroughs(facts, zones),
        marts.trips_by_daypart(facts, calendar(spark, "2024-01-01", "2024-02-29")),
    ):
        text = plan(mart)
        tree = text[: text.index("(1)")]
        assert "Cartesian" not in tree and "NestedLoop" not in tree
        join = min(tree.index(kind) for kind in ("SortMergeJoin", "BroadcastHashJoin") if kind in tree)
        assert "HashAggregate" in tree[join : tree.index("WindowGroupLimit")]
    top = plan(marts.top_pickup_zones(facts, zones))
    assert "TakeOrderedAndProject" in top


def test_a_hot_month_is_written_as_several_files(spark, tmp_path):
    one = silver_trips(bronze(spark, {}))
    many = one.drop("trip_id").join(spark.range(60_000).selectExpr("md5(cast(id AS string)) AS trip_id"))
    rare = one.withColumn("pickup_datetime", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400k")
    try:
        facts = fact_trips(many.unionByName(rare).repartition(8, "trip_id"))
        write_fact(facts, str(tmp_path / "fact"))
    finally:
        spark.conf.set(key, before)
    files = {}
    for file in (tmp_path / "fact").glob("*/*.parquet"):
        files[file.parent.name[13:20]] = files.get(file.parent.name[13:20], 0) + 1
    assert files["2024-01"] > 3 and files["2024-03"] == 1
    stored = read_fact(spark, str(tmp_path / "fact"))
    assert stored.count() == 60_001
    assert FACT_PARTITIONS == ["pickup_month"] and stored.schema == FACT
