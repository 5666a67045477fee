from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.contracts import ZONE_SEED


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header; blank lines are skipped and NA, N/A stay text."""
    return (
        spark.read.schema(ZONE_SEED)
        .option("header", "true")
        .option("nullValue", "")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )
