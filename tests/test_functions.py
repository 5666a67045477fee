from __future__ import annotations

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.trips import at
from tripflow import functions as fn
from tripflow.periods import check_period, target_month, target_periods


def pairs(spark, rows):
    return spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_minute_steps_count_boundaries_in_any_zone(spark, zone):
    random.seed(1)
    base = datetime(2024, 3, 10)
    rows = [
        (base + timedelta(seconds=random.randrange(200_000)), base + timedelta(seconds=random.randrange(200_000)))
        for _ in range(500)
    ]
    rows += [
        (at("2024-01-01 00:00:59"), at("2024-01-01 00:01:01")),
        (at("2024-01-01 00:00:01"), at("2024-01-01 00:00:59")),
        (at("2024-01-01 00:01:00"), at("2023-12-31 23:59:59")),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        steps = fn.minute_steps(F.col("a"), F.col("b"))
        found = [row["steps"] for row in pairs(spark, rows).select(steps.alias("steps")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime(1970, 1, 1)
    expected = [(b - epoch) // timedelta(minutes=1) - (a - epoch) // timedelta(minutes=1) for a, b in rows]
    assert found == expected
    assert expected[-3:] == [1, 0, -2]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_truncation_keeps_wall_clock(spark, zone):
    # 02:30 on that day does not exist in New York.
    row = pairs(spark, [(at("2024-03-10 02:30:15.5"), None)])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a = F.col("a")
        got = row.select(fn.month_start(a), fn.midnight(a), fn.hour_start(a), fn.day_of_week(a)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == (at("2024-03-01"), at("2024-03-10"), at("2024-03-10 02:00:00"), 0)


def test_surrogate_key_keeps_places_of_nulls(spark):
    rows = spark.createDataFrame(
        [(1, at("2024-01-01 00:00:07.1"), None, 4), (None, at("2024-01-01 00:00:07"), None, None)],
        "v int, p timestamp_ntz, d timestamp_ntz, z int",
    )
    found = [row[0] for row in rows.select(fn.surrogate_key("v", "p", "d", "z")).collect()]
    texts = ["1-2024-01-01 00:00:07.1--4", "-2024-01-01 00:00:07--"]
    assert found == [hashlib.md5(text.encode()).hexdigest() for text in texts]


def test_ratio_is_zero_without_a_positive_denominator(spark):
    rows = spark.createDataFrame(
        [(6.0, 3.0), (6.0, 0.0), (6.0, -1.0), (6.0, None), (None, 2.0)], "n double, d double"
    )
    found = [row[0] for row in rows.select(fn.ratio_or_zero(F.col("n"), F.col("d"))).collect()]
    assert found == [2.0, 0.0, 0.0, 0.0, None]


def test_hour_bands(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    bands = hours.select("h", fn.daypart(F.col("h")), fn.is_rush_hour(F.col("h"))).collect()
    part = {row[0]: row[1] for row in bands}
    rush = [row[0] for row in bands if row[2]]
    assert rush == [7, 8, 9, 16, 17, 18, 19]
    assert [h for h in part if part[h] == "Morning"] == list(range(6, 12))
    assert [h for h in part if part[h] == "Afternoon"] == list(range(12, 17))
    assert [h for h in part if part[h] == "Evening"] == list(range(17, 21))
    assert part[16] == "Afternoon" and 16 in rush
    assert part[5] == part[21] == "Night"


def test_borough_and_airport(spark):
    rows = spark.createDataFrame(
        [("EWR", "Newark"), ("Queens", "JFK Airport"), ("Bronx", None), (None, "NA"), ("Unknown", "NV")],
        "borough string, zone string",
    )
    found = rows.select(
        fn.borough_group(F.col("borough")), fn.is_airport(F.col("zone"), F.col("borough"))
    ).collect()
    assert [tuple(row) for row in found] == [
        ("Airport", True),
        ("Queens", True),
        ("Bronx", False),
        ("Unknown", False),
        ("Unknown", False),
    ]


def test_target_month_is_thirteen_months_back(spark):
    days = ["2028-03-05", "2029-02-05", "2029-03-05", "2026-02-05", "2024-01-31"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date"))
    found = [str(row[0]) for row in rows.select(target_month(F.col("d"))).collect()]
    assert found == ["2027-02-01", "2028-01-01", "2028-02-01", "2025-01-01", "2022-12-01"]


def test_target_periods_drop_months_before_the_first_year(spark):
    rows = spark.createDataFrame([("2010-01-05",), ("2010-02-05",), ("2010-02-20",), (None,)], "d string")
    found = target_periods(rows.select(F.col("d").cast("date")), "d").collect()
    assert [tuple(row) for row in found] == [(2009, 1, 2)]


@pytest.mark.parametrize(("year", "month"), [(2024, 0), (2024, 13), (2008, 5)])
def test_period_bounds(year, month):
    with pytest.raises(ValueError):
        check_period(year, month)
