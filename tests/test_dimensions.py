from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.trips import at, bronze
from tripflow.operators.dimensions import calendar, date_spine, day_bounds, dim_zones, stg_zones
from tripflow.operators.fact import fact_trips
from tripflow.operators.lookup import with_calendar, with_zones
from tripflow.operators.sample import sample_rows
from tripflow.operators.silver import silver_trips
from tripflow.plans import marts
from tripflow.sources.seeds import read_zone_seed

SEED = """LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
4,Manhattan,Alphabet City,Yellow Zone
132,Queens,JFK Airport,Airports
163,EWR,Newark Airport,EWR
264,Unknown,NV,N/A
265,Unknown,NA,N/A


"""


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("seed") / "zones.csv"
    path.write_text(SEED)
    return dim_zones(stg_zones(read_zone_seed(spark, str(path))))


def test_seed_and_zones(zones):
    rows = {r["zone_id"]: r for r in zones.collect()}
    assert sorted(rows) == [1, 4, 132, 163, 264, 265]
    assert rows[265]["zone_name"] == "NA" and rows[265]["service_zone"] == "N/A"
    assert rows[265]["borough_group"] == "Unknown" and rows[265]["is_airport"] is False
    assert rows[1]["borough_group"] == "Airport" and rows[1]["is_airport"] is True
    assert rows[132]["is_airport"] is True and rows[132]["borough_group"] == "Queens"


def test_calendar(spark):
    frame = calendar(spark)
    totals = frame.agg(
        F.count("*"), F.countDistinct("datetime_hour"), F.sum("day_of_week"), F.sum("week_of_year"), F.sum("day_of_year")
    ).first()
    assert tuple(totals) == (96_432, 96_432, 289_296, 2_564_352, 17_660_232)
    row = frame.filter(F.col("datetime_hour") == F.lit("2021-01-03 16:00:00").cast("timestamp_ntz")).first()
    assert (row["week_of_year"], row["day_of_week"], row["is_weekend"]) == (53, 0, True)
    assert (row["is_rush_hour"], row["time_of_day"]) == (True, "Afternoon")
    assert (row["day_name"], row["month_name"], row["year_month"], row["quarter"]) == ("Sunday", "January", "2021-01", 1)
    assert row["date_day"] == date(2021, 1, 3)


def test_spine_follows_the_data(spark):
    trips = bronze(spark, {}, {"tpep_pickup_datetime": at("2024-01-17 23:59:59")}, {"tpep_pickup_datetime": None})
    hours = date_spine(day_bounds(trips, "tpep_pickup_datetime"))
    assert hours.count() == 72
    assert hours.agg(F.max("datetime_hour")).first()[0] == at("2024-01-17 23:00:00")


def test_marts(spark, zones):
    trips = [{"PULocationID": z, "VendorID": v, "total_amount": 10.0} for z, n in ((4, 3), (132, 3), (1, 1), (99, 5)) for v in range(n)]
    facts = fact_trips(silver_trips(bronze(spark, *trips)))
    counts = {r["pickup_location_id"]: (r["zone_name"], r["trips"]) for r in marts.trips_by_zone(facts, zones).collect()}
    assert counts == {4: ("Alphabet City", 3), 132: ("JFK Airport", 3), 1: ("Newark Airport", 1), 99: (None, 5)}
    top = marts.top_pickup_zones(facts, zones, 2).collect()
    assert [r["pickup_location_id"] for r in top] == [99, 4]
    kpis = marts.kpi_summary(facts).first()
    assert tuple(kpis) == (120.0, 12, 120.0 / 48.0)
    assert marts.kpi_summary(facts.limit(0)).first()["revenue_per_mile"] is None
    still = marts.kpi_summary(facts.withColumn("trip_distance", F.lit(0.0))).first()
    assert still["revenue_per_mile"] is None
    grid = marts.heatmap_grid(facts).first()
    assert (grid["pickup_day_of_week"], grid["hour_08"], grid["hour_09"]) == (1, 12, 0)
    parts = marts.trips_by_daypart(facts, calendar(spark, "2024-01-01", "2024-01-31")).collect()
    assert [tuple(r) for r in parts] == [("Morning", True, False, 12, 120.0)]
    off = marts.trips_by_daypart(facts, calendar(spark, "2023-01-01", "2023-01-31")).collect()
    assert [tuple(r) for r in off] == [(None, None, None, 12, 120.0)]


def test_row_level_joins_keep_every_trip(spark, zones):
    facts = fact_trips(silver_trips(bronze(spark, {"PULocationID": 1, "DOLocationID": 99}, {"PULocationID": None})))
    named = {r["pickup_location_id"]: r for r in with_zones(facts, zones).collect()}
    assert named[1]["pickup_zone_name"] == "Newark Airport" and named[1]["dropoff_zone_name"] is None
    assert named[None]["pickup_borough_group"] is None
    hours = with_calendar(facts, calendar(spark, "2024-01-15", "2024-01-15"))
    assert {r["time_of_day"] for r in hours.collect()} == {"Morning"} and hours.count() == 2


def test_lookups_run_no_job_while_they_are_built(spark, zones):
    spark.sparkContext.setJobGroup("building", "lookups")
    facts = fact_trips(silver_trips(bronze(spark, {})))
    with_calendar(with_zones(facts, zones), calendar(spark, "2024-01-15", "2024-01-15"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "")


def test_a_stray_date_spreads_over_tasks(spark):
    bounds = lambda low, high: spark.createDataFrame([(low, high)], "a string, b string").selectExpr(
        "cast(a AS date) AS first_day", "cast(b AS date) AS last_day"
    )
    hours = date_spine(bounds("1024-01-01", "5000-01-01"))
    tasks = hours.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in tasks) == 24 * ((date(5000, 1, 1) - date(1024, 1, 1)).days + 1)
    assert len(tasks) >= 3
    assert "Exchange" not in hours._jdf.queryExecution().sparkPlan().toString().partition("Subquery")[0]
    ends = date_spine(bounds("0001-01-01", "0001-01-01")).union(date_spine(bounds("9999-12-31", "9999-12-31")))
    assert ends.count() == 48
    assert date_spine(bounds(None, None)).count() == 0


def test_all_zones_are_ranked(spark, zones):
    trips = [{"PULocationID": place, "VendorID": v} for place, n in ((99, 3), (1, 2), (None, 1)) for v in range(n)]
    top = marts.top_pickup_zones(fact_trips(silver_trips(bronze(spark, *trips))), zones).collect()
    assert [(row["pickup_location_id"], row["trips"]) for row in top] == [(99, 3), (1, 2), (None, 1)]
    assert top[0]["zone_name"] is None


def test_sample_is_exact_and_whole_below_the_cap(spark):
    rows = spark.range(50_000)
    assert sample_rows(rows, 60_000).count() == 50_000
    for cap in (1, 1_000, 49_999):
        drawn = sample_rows(rows, cap, seed=3)
        assert drawn.count() == cap
        assert drawn.distinct().count() == cap
    mean = sample_rows(rows, 5_000, seed=3).agg(F.avg("id")).first()[0]
    assert abs(mean - 25_000) < 1_500


def test_sample_puts_no_more_than_one_slot_into_one_task(spark):
    rows = spark.range(0, 400_000, 1, 8)
    drawn = sample_rows(rows, 300_000, seed=5)
    assert drawn.count() == drawn.distinct().count() == 300_000
    limited = drawn._jdf.queryExecution().optimizedPlan().toString()
    cut = int(limited.partition("GlobalLimit ")[2].split()[0])
    assert 0 < cut <= 4096
    assert sorted(map(tuple, sample_rows(rows, 1000, 9).collect())) == sorted(map(tuple, sample_rows(rows, 1000, 9).collect()))
