"""Reads of stored layers. The contract is passed in, so nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import BRONZE, FACT
from tripflow.paths import partition_path
from tripflow.sources.published import is_published, read_published


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All months: partition folders, or what the log of a published table says."""
    if is_published(spark, path):
        return read_published(spark, path, BRONZE)
    return spark.read.schema(BRONZE).parquet(path)


def read_bronze_month(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """One month, listing only its own folder."""
    if is_published(spark, path):
        return read_published(spark, path, BRONZE).filter((F.col("_year") == year) & (F.col("_month") == month))
    leaf = partition_path(path, {"_year": year, "_month": month})
    return spark.read.schema(BRONZE).option("basePath", path).parquet(leaf)


def bronze_view(spark: SparkSession, path: str, name: str = "trips_bronze") -> DataFrame:
    """Registers the partitioned files as a SQL view and returns it."""
    read_bronze(spark, path).createOrReplaceTempView(name)
    return spark.table(name)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    if is_published(spark, path):
        return read_published(spark, path, FACT, judged=True)
    return spark.read.schema(FACT).parquet(path).select(*FACT.names)


def latest_pickup(fact: DataFrame) -> DataFrame:
    """One row, the newest pickup in a stored fact (NULL when it is empty).

    The newest pickup lies in the newest month, so only that partition's column is read.
    """
    newest = fact.agg(F.max("pickup_month")).scalar()
    return fact.filter(F.col("pickup_month") == newest).agg(
        F.max("pickup_datetime").alias("pickup_datetime")
    )
