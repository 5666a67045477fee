"""Adapters that shape the test tables into trips, zones and raw deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
    l_quantity double, l_extendedprice double, l_discount double, l_tax double,
    l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""

# Minutes and seconds added to the ship time give a trip's start and end; amounts follow prices.
START = "timestampadd(SECOND, l_partkey % 1440 * 60 + l_orderkey % 60, l_shipdate)"
END = """timestampadd(SECOND, (l_partkey % 1440 + cast(l_quantity AS bigint) - 2) * 60
    + l_orderkey % 60 + l_suppkey % 97, l_shipdate)"""
TRIP = {
    "VendorID": "cast(l_linenumber AS int)",
    "tpep_pickup_datetime": START,
    "tpep_dropoff_datetime": END,
    "passenger_count": "cast(l_quantity AS bigint) % 7",
    "trip_distance": "l_quantity * 11.0E0 - 20.0E0",
    "RatecodeID": "l_orderkey % 6 + 1",
    "store_and_fwd_flag": "if(l_returnflag = 'R', 'Y', 'N')",
    "PULocationID": "cast(l_suppkey % 27 AS int)",
    "DOLocationID": "cast(l_partkey % 27 AS int)",
    "payment_type": "l_partkey % 8",
    "fare_amount": "l_extendedprice / 100.0E0",
    "extra": "l_tax * 10.0E0",
    "mta_tax": "0.5E0",
    "tip_amount": "l_extendedprice / 100.0E0 * l_discount + tip_step",
    "tolls_amount": "0.0E0",
    "improvement_surcharge": "1.0E0",
    "total_amount": """l_extendedprice / 100.0E0 * (1.0E0 + l_discount) + l_tax * 10.0E0
        + 1.5E0 + tip_step""",
    "congestion_surcharge": "2.5E0",
    "Airport_fee": "if(l_suppkey % 27 IN (1, 24), 1.75E0, 0.0E0)",
}
LINEAGE = {
    "_ingested_at": "if(batch = 2, timestamp_ntz'2026-01-02', timestamp_ntz'2026-01-01')",
    "_source_file": "if(batch = 2, 'batch2.parquet', 'batch1.parquet')",
    "_year": "year(l_shipdate)",
    "_month": "month(l_shipdate)",
}

# Batch 1 is every order line. Batch 2 is a later delivery that repeats every tenth order with
# another tip, which gives deduplication and upsert their overlap.
DELIVERIES = {
    (1,): "array(1)",
    (2,): "if(l_orderkey % 10 = 0, array(2), array())",
    (1, 2): "if(l_orderkey % 10 = 0, array(1, 2), array(1))",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINES).parquet(f"{sf_dir}/lineitem.parquet")


def _expressions(columns: dict[str, str]) -> list[str]:
    return [f"{value} AS {name}" for name, value in columns.items()]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw columns of one trip per order line, and the line's ship time."""
    lines = order_lines(spark, sf_dir).withColumn("tip_step", F.lit(0.0))
    return lines.selectExpr(*_expressions(TRIP), "l_shipdate")


# All order lines as three monthly deliveries of one year.
DELIVERY_MONTHS = {
    1: "tpep_pickup_datetime < timestamp_ntz'1994-07-01'",
    2: "tpep_pickup_datetime >= timestamp_ntz'1994-07-01' AND tpep_pickup_datetime < timestamp_ntz'1996-07-01'",
    3: "tpep_pickup_datetime >= timestamp_ntz'1996-07-01'",
}

# The same as three deliveries that do not follow the pickup time.
MIXED = "(RatecodeID - 1) % 3 + 1"

# What the checks would reject, brought inside their bounds.
CLEAN = {
    "trip_distance": "l_quantity * 1.0E0",
    "PULocationID": "cast(l_suppkey % 25 AS int)",
    "DOLocationID": "cast(l_partkey % 25 AS int)",
    "payment_type": "l_partkey % 7",
    "fare_amount": "l_extendedprice / 1000.0E0",
    "total_amount": "l_extendedprice / 1000.0E0 + 4.0E0",
}


def clean_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns that pass all checks."""
    lines = order_lines(spark, sf_dir).withColumn("tip_step", F.lit(0.0))
    return lines.selectExpr(*_expressions(TRIP | CLEAN))


def bronze_trips(
    spark: SparkSession, sf_dir: str, batches: tuple[int, ...] = (1, 2)
) -> DataFrame:
    lines = order_lines(spark, sf_dir).selectExpr(
        "*", f"explode(cast({DELIVERIES[batches]} AS array<int>)) AS batch"
    )
    trips = lines.withColumn("tip_step", F.expr("if(batch = 2, 1.0E0, 0.0E0)"))
    return trips.selectExpr(*_expressions(TRIP | LINEAGE))


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).selectExpr(
        "n_nationkey AS LocationID",
        """CASE r_name WHEN 'AFRICA' THEN 'Manhattan' WHEN 'AMERICA' THEN 'Brooklyn'
            WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'EWR' ELSE 'Unknown' END AS Borough""",
        "if(n_nationkey IN (2, 7), concat(n_name, ' Airport'), n_name) AS Zone",
        "if(n_nationkey % 3 = 0, 'Yellow Zone', 'Boro Zone') AS service_zone",
    )
