"""Writers shared by all layers. A table is a folder of Parquet, optionally in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.paths import partition_path

CODEC = "zstd"  # about a third less than Spark's default


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partitions: Sequence[str] = (),
    recover: bool = True,
) -> None:
    """Creates the layer's database and an external table over ``path``, if absent. Its partitions are
    taken from the folders there, unless ``recover`` is False."""
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{path}'")
    if partitions and recover:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType | str, partitions: Sequence[str] = ()
) -> None:
    """Creates an empty table folder, unless there is one."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partitions).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Full refresh."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replaces exactly the partitions that have rows in ``df``.

    New files are written beside the table and moved in when the job commits, so a failed
    job leaves the old partitions alone, and ``df`` may read the table it replaces.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partitions)
        .parquet(path)
    )


def clear_partition(
    spark: SparkSession, path: str, schema: T.StructType, values: Mapping[str, object]
) -> None:
    """Leaves one partition without rows; replacing by content cannot express that."""
    stored = T.StructType([f for f in schema.fields if f.name not in values])
    empty = spark.createDataFrame([], stored)
    empty.write.mode("overwrite").parquet(partition_path(path, values))
