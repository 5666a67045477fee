"""Trip fact: time parts, duration and ratios on top of silver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.contracts import AUDIT, FACT, SILVER, TRIP_KEY
from tripflow.functions import day_of_week, midnight, minute_steps, month_start, ratio_or_zero, surrogate_key

# Derived fact column -> the silver columns it is made of.
MADE_FROM = {
    "pickup_location_id": ["pickup_zone_id"],
    "dropoff_location_id": ["dropoff_zone_id"],
    "pickup_month": ["pickup_datetime"],
    "pickup_date": ["pickup_datetime"],
    "pickup_hour": ["pickup_datetime"],
    "pickup_day_of_week": ["pickup_datetime"],
    "trip_duration_minutes": ["pickup_datetime", "dropoff_datetime"],
    "fare_per_mile": ["fare_amount", "trip_distance"],
    "tip_percentage": ["tip_amount", "total_amount"],
    AUDIT: [],
}


def derived_column(name: str) -> Column:
    pickup, dropoff = "pickup_datetime", "dropoff_datetime"
    match name:
        case "pickup_location_id":
            value = F.col("pickup_zone_id")
        case "dropoff_location_id":
            value = F.col("dropoff_zone_id")
        case "pickup_month":
            value = month_start(F.col(pickup))
        case "pickup_date":
            value = midnight(F.col(pickup))
        case "pickup_hour":
            value = F.hour(pickup)
        case "pickup_day_of_week":
            value = day_of_week(F.col(pickup))
        case "trip_duration_minutes":
            value = minute_steps(F.col(pickup), F.col(dropoff))
        case "fare_per_mile":
            value = ratio_or_zero(F.col("fare_amount"), F.col("trip_distance"))
        case "tip_percentage":
            value = ratio_or_zero(F.col("tip_amount"), F.col("total_amount"))
        case _:
            value = F.current_timestamp()
    return value.alias(name)


def silver_inputs(columns: Iterable[str]) -> list[str]:
    """The silver columns needed to build some fact columns."""
    needed = set()
    for name in columns:
        needed.update(MADE_FROM.get(name, [name]))
    return [name for name in SILVER.names if name in needed]


def fact_trips(silver: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return silver.select(
        *[derived_column(name) if name in MADE_FROM else name for name in columns or FACT.names]
    )


def later_than(silver: DataFrame, mark: Column) -> DataFrame:
    """Trips picked up strictly after the high-water mark; all of them when it is NULL.

    The mark may be a literal or a scalar subquery. Pickup is part of the dedup key, so
    Catalyst moves the predicate below the window and down to the bronze scan.
    """
    floor = F.coalesce(mark, F.lit("-9999-01-01 00:00:00").cast("timestamp_ntz"))
    return silver.filter(F.col("pickup_datetime") > floor)


# Fact columns that a stored row's other columns give.
IMPLIED = [name for name, made in MADE_FROM.items() if made and name not in ("pickup_location_id", "dropoff_location_id")]


def implied_columns() -> dict[str, Column]:
    """``trip_id`` and the derived columns, from the other columns of a fact."""
    key = ["pickup_location_id" if name == "pickup_zone_id" else name for name in TRIP_KEY]
    return {"trip_id": surrogate_key(*key)} | {name: derived_column(name) for name in IMPLIED}


def packed(fact: DataFrame) -> DataFrame:
    """The fact for a shuffle: columns that the others give are left out (NULL) in rows where all of them agree,
    which ``_implied`` tells."""
    agree = reduce(Column.__and__, [F.col(name).eqNullSafe(value) for name, value in implied_columns().items()])
    rows = fact.withColumn("_implied", agree)
    return rows.withColumns({name: F.when(~F.col("_implied"), F.col(name)) for name in implied_columns()})


def unpacked(rows: DataFrame) -> DataFrame:
    """What ``packed`` was given."""
    own = {name: F.when(F.col("_implied"), value).otherwise(F.col(name)) for name, value in implied_columns().items()}
    return rows.withColumns(own).drop("_implied")
