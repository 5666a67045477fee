"""Serving questions over the star schema.

Facts are counted per key before they meet a dimension, so joins see at most one row per
zone or hour and need no broadcast of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import hour_start

TRIPS = "trips"


def kpi_summary(fact: DataFrame) -> DataFrame:
    revenue, miles = F.sum("total_amount"), F.sum("trip_distance")
    return fact.agg(
        revenue.alias("total_revenue"),
        F.count(F.lit(1)).alias("total_trips"),
        F.try_divide(revenue, miles).alias("revenue_per_mile"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("pickup_month")
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy("pickup_month")
    )


def trips_by_zone(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per pickup zone, zones without an entry in the dimension included."""
    counts = fact.groupBy("pickup_location_id").agg(F.count(F.lit(1)).alias(TRIPS))
    return counts.join(
        zones, counts["pickup_location_id"] == zones["zone_id"], "left"
    ).select("pickup_location_id", "zone_name", "borough", TRIPS)


def top_pickup_zones(fact: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """The n busiest pickup zones; equal counts go by zone id, a NULL one last.

    A zone without a name, or without an entry in the dimension, ranks like any other.
    """
    order = [F.desc(TRIPS), F.col("pickup_location_id").asc_nulls_last()]
    return trips_by_zone(fact, zones).orderBy(*order).limit(n)


def trips_between_boroughs(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per pickup and dropoff borough group; the zone dimension is joined twice."""
    pairs = fact.groupBy("pickup_location_id", "dropoff_location_id").agg(
        F.count(F.lit(1)).alias("pair_trips")
    )
    for side in ("pickup", "dropoff"):
        group = zones.select(
            F.col("zone_id").alias(f"{side}_location_id"),
            F.col("borough_group").alias(f"{side}_borough_group"),
        )
        pairs = pairs.join(group, f"{side}_location_id", "left")
    return pairs.groupBy("pickup_borough_group", "dropoff_borough_group").agg(
        F.sum("pair_trips").alias(TRIPS)
    )


def hourly_heatmap(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pickup_day_of_week", "pickup_hour").agg(F.count(F.lit(1)).alias(TRIPS))


def heatmap_grid(fact: DataFrame) -> DataFrame:
    """The heatmap with one column per hour; empty cells are 0."""
    hours = list(range(24))
    grid = hourly_heatmap(fact).groupBy("pickup_day_of_week").pivot("pickup_hour", hours).sum(TRIPS)
    return grid.select(
        "pickup_day_of_week",
        *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"hour_{h:02d}") for h in hours],
    )


def trips_by_daypart(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips and revenue per day part and rush-hour flag, hours off the calendar as NULL."""
    hourly = fact.groupBy(hour_start(F.col("pickup_datetime")).alias("datetime_hour")).agg(
        F.count(F.lit(1)).alias("hour_trips"), F.sum("total_amount").alias("hour_revenue")
    )
    slots = calendar.select("datetime_hour", "time_of_day", "is_rush_hour", "is_weekend")
    return (
        hourly.join(slots, "datetime_hour", "left")
        .groupBy("time_of_day", "is_rush_hour", "is_weekend")
        .agg(F.sum("hour_trips").alias(TRIPS), F.sum("hour_revenue").alias("revenue"))
    )
