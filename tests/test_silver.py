from __future__ import annotations

from pyspark.sql import functions as F

from tests.trips import at, bronze
from tripflow.contracts import FACT, SILVER, TIE_BREAK, TRIP_KEY
from tripflow.operators.fact import fact_trips
from tripflow.operators.silver import rename_trips, silver_trips, tie_break_for, valid_trips
from tripflow.plans.star import FACT_VALUES, fact_from_bronze

NAN = float("nan")


def test_contract_columns_and_types(spark):
    silver = silver_trips(bronze(spark, {}))
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    fact = fact_trips(silver)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT]


def test_filter_bounds_null_and_nan(spark):
    kept = [
        {"trip_distance": 0.0},
        {"trip_distance": 500.0},
        {"fare_amount": 1000.0},
        {"total_amount": 2000.0},
        {"VendorID": None, "PULocationID": None},
    ]
    dropped = [
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        *[
            {column: value}
            for column, above in (
                ("trip_distance", 500.1),
                ("fare_amount", 1000.1),
                ("total_amount", 2000.1),
            )
            for value in (above, -0.1, None, NAN)
        ],
    ]
    rows = [row | {"passenger_count": 1} for row in kept] + [
        row | {"passenger_count": 0} for row in dropped
    ]
    found = valid_trips(rename_trips(bronze(spark, *rows)))
    assert [row["passenger_count"] for row in found.collect()] == [1] * len(kept)


def test_newest_copy_wins_and_null_keys_group(spark):
    old, new = at("2025-01-01"), at("2025-01-02")
    rows = [
        {"_ingested_at": old, "tip_amount": 1.0},
        {"_ingested_at": new, "tip_amount": 2.0},
        {"_ingested_at": None, "tip_amount": 3.0},
        {"VendorID": None, "PULocationID": None, "_ingested_at": old, "tip_amount": 4.0},
        {"VendorID": None, "PULocationID": None, "_ingested_at": new, "tip_amount": 5.0},
        {"VendorID": None, "_ingested_at": old, "tip_amount": 6.0},
    ]
    found = silver_trips(bronze(spark, *rows)).collect()
    assert sorted(row["tip_amount"] for row in found) == [2.0, 5.0, 6.0]
    assert len({row["trip_id"] for row in found}) == 3


def test_equal_stamps_give_the_same_row_in_any_order(spark):
    rows = [{"DOLocationID": zone, "tip_amount": tip} for zone in (7, 5, None) for tip in (3.0, 1.0, 2.0)]
    results = set()
    for step in (1, -1):
        for parts in (1, 5):
            frame = bronze(spark, *rows[::step]).repartition(parts)
            (row,) = silver_trips(frame).collect()
            results.add((row["dropoff_zone_id"], row["tip_amount"]))
    assert results == {(5, 1.0)}


def test_tie_break_covers_every_column_outside_the_key():
    assert sorted([*TIE_BREAK, *TRIP_KEY, "trip_id", "_ingested_at"]) == sorted(SILVER.names)
    assert tie_break_for(["trip_id"]) == []
    assert tie_break_for(["fare_amount"]) == TIE_BREAK[:3]


def test_subset_of_columns_agrees_with_the_full_table(spark):
    rows = [
        {"VendorID": v, "DOLocationID": d, "trip_distance": m, "tip_amount": t, "payment_type": p}
        for v in range(20)
        for d, m, t, p in [(3, 1.0, 2.0, 1), (3, 1.0, 1.0, 2), (3, 1.0, 1.0, 1), (4, 0.5, 0.0, 0)]
    ]
    source = bronze(spark, *rows)
    full = fact_from_bronze(source)
    for column in FACT_VALUES:
        part = fact_from_bronze(source, ["vendor_id", column]).collect()
        whole = full.select("vendor_id", column).collect()
        assert sorted(map(str, part)) == sorted(map(str, whole)), column


def test_one_key_with_a_third_of_all_rows(spark):
    hot = spark.range(30_000).select(F.lit(1).alias("v"), F.col("id").cast("int").alias("n"))
    cold = spark.range(60_000).select((F.col("id") + 2).cast("int").alias("v"), F.lit(0).alias("n"))
    both = hot.union(cold).crossJoin(F.broadcast(bronze(spark, {}))).withColumn("VendorID", F.col("v"))
    source = both.withColumn("DOLocationID", F.col("n")).drop("v", "n")
    silver = silver_trips(source)
    assert silver.count() == 60_001
    assert silver.filter("vendor_id = 1").first()["dropoff_zone_id"] == 0


def test_periods_prune_before_deduplication(spark):
    rows = [
        {"_month": 1, "tip_amount": 1.0},
        {"_month": 2, "tip_amount": 2.0, "_ingested_at": at("2026-01-01")},
        {"_month": 3, "VendorID": 2},
    ]
    source = bronze(spark, *rows)
    only = silver_trips(source, periods=[(2024, 1)]).collect()
    assert [row["tip_amount"] for row in only] == [1.0]
    assert silver_trips(source, periods=[(2024, 1), (2024, 3)]).count() == 2
    assert silver_trips(source, periods=[]).count() == 0


def test_fact_values(spark):
    rows = [
        {
            "tpep_pickup_datetime": at("2024-02-04 23:59:59"),
            "tpep_dropoff_datetime": at("2024-02-05 00:00:01"),
            "trip_distance": 0.0,
            "total_amount": 0.0,
        },
        {"tpep_dropoff_datetime": at("2024-01-15 07:58:30"), "VendorID": 2},
    ]
    late, early = fact_trips(silver_trips(bronze(spark, *rows))).orderBy("vendor_id").collect()
    assert late["pickup_month"] == at("2024-02-01") and late["pickup_date"] == at("2024-02-04")
    assert (late["pickup_hour"], late["pickup_day_of_week"]) == (23, 0)
    assert late["trip_duration_minutes"] == 1
    assert (late["fare_per_mile"], late["tip_percentage"]) == (0.0, 0.0)
    assert early["trip_duration_minutes"] == -2
    assert early["fare_per_mile"] == 5.0
    assert early["tip_percentage"] == 5.0 / 26.5
