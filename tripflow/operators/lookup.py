"""Row-level lookups of dimensions. No hint: AQE broadcasts a side whose shuffled size allows it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import hour_start


def with_zones(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Every trip with its pickup and its dropoff zone; unknown zones stay NULL."""
    zones = zones.select("zone_id", "borough_group", "zone_name", "is_airport")
    for side in ("pickup", "dropoff"):
        named = zones.select(*[F.col(c).alias(f"{side}_{c}") for c in zones.columns])
        fact = fact.join(
            named, F.col(f"{side}_location_id") == F.col(f"{side}_zone_id"), "left"
        ).drop(f"{side}_zone_id")
    return fact


def with_calendar(fact: DataFrame, calendar: DataFrame, hour: Column | None = None) -> DataFrame:
    """Every trip with the calendar row of its pickup hour; hours off the calendar stay NULL."""
    hour = hour_start(F.col("pickup_datetime")) if hour is None else hour
    slots = calendar.select("datetime_hour", "time_of_day", "is_rush_hour", "is_weekend")
    return fact.withColumn("_hour", hour).join(
        slots, F.col("_hour") == F.col("datetime_hour"), "left"
    ).drop("_hour")
