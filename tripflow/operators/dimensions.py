"""Zone and hourly calendar dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import AUDIT, CALENDAR_END, CALENDAR_START, ZONE_NAMES
from tripflow.functions import (
    borough_group,
    day_of_week,
    daypart,
    is_airport,
    is_rush_hour,
    is_weekend,
)


def stg_zones(seed: DataFrame) -> DataFrame:
    return seed.select(*[F.col(raw).alias(clean) for raw, clean in ZONE_NAMES.items()])


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        *ZONE_NAMES.values(),
        borough_group(F.col("borough")).alias("borough_group"),
        is_airport(F.col("zone_name"), F.col("borough")).alias("is_airport"),
        F.current_timestamp().alias(AUDIT),
    )


# The days of the SQL date type, 0001-01-01 to 9999-12-31, counted from 1970-01-01.
FIRST_DAY, LAST_DAY = -719162, 2932896


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every hour of every day from ``first_day`` to ``last_day`` of a one-row frame.

    Days are those between the bounds among all days of the calendar, which tasks generate in ranges and test
    in place. So there is neither a join nor an exchange, and a stray date far off spreads over tasks. Bounds
    outside the years 1 to 9999 are cut to them; NULL bounds give no days.
    """
    ends = F.struct(F.unix_date("first_day").alias("low"), F.unix_date("last_day").alias("high"))
    ends = bounds.select(ends.alias("ends")).scalar()
    days = bounds.sparkSession.range(FIRST_DAY, LAST_DAY + 1)
    days = days.filter((F.col("id") >= ends["low"]) & (F.col("id") <= ends["high"]))
    days = days.select(F.date_from_unix_date(F.col("id").cast("int")).alias("date_day"))
    hours = days.select("date_day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))
    return hours.select(
        F.timestamp_add("HOUR", "hour_of_day", F.col("date_day").cast("timestamp_ntz")).alias(
            "datetime_hour"
        ),
        "date_day",
        "hour_of_day",
    )


def day_bounds(trips: DataFrame, column: str) -> DataFrame:
    """First and last day seen in a timestamp column, as input for ``date_spine``."""
    day = F.col(column).cast("date")
    return trips.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def dim_datetime(spine: DataFrame) -> DataFrame:
    day, hour = F.col("date_day"), F.col("hour_of_day")
    return spine.select(
        "datetime_hour",
        "date_day",
        "hour_of_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        day_of_week(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        is_weekend(day).alias("is_weekend"),
        is_rush_hour(hour).alias("is_rush_hour"),
        daypart(hour).alias("time_of_day"),
        F.current_timestamp().alias(AUDIT),
    )


def calendar(
    spark: SparkSession,
    first: str | date = CALENDAR_START,
    last: str | date = CALENDAR_END,
) -> DataFrame:
    """The calendar dimension of a fixed range."""
    bounds = spark.range(1).select(
        F.lit(str(first)).cast("date").alias("first_day"),
        F.lit(str(last)).cast("date").alias("last_day"),
    )
    return dim_datetime(date_spine(bounds))
