"""A trip fact bucketed and sorted by its key, for tables that are mostly looked up, joined or upserted by key.

The table is a catalog view over the newest of its versions, each a bucketed table partitioned by month.
Spark knows that equal keys of a version lie in one bucket: joins and deduplication by ``trip_id`` read the
stored side without an exchange, and what an upsert writes is dealt as it is stored. A new version is
written beside the old one and the view moved to it in one step, so a lost job leaves the old version readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contracts import FACT, FACT_PARTITIONS
from tripflow.operators.merge import delete_insert
from tripflow.session import stage
from tripflow.sinks.tables import CODEC
from tripflow.sources.published import exists

KEY = "trip_id"
BUCKET_BYTES = 1 << 30
ROW_BYTES = 512  # of a fact in the sorts of a task that merges and writes a bucket


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of a table of this size. A bucket is one task of a join, and a file in every month."""
    return max(8, -(-table_bytes // bucket_bytes))


def buckets_of(rows: int) -> int:
    """Buckets of a table of so many facts, each merged and written within about ``BUCKET_BYTES`` of memory."""
    return buckets_for(rows * ROW_BYTES)


def versions(spark: SparkSession, name: str) -> list[str]:
    """Versions of the table, oldest first."""
    database, _, table = name.rpartition(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}_v*'").collect()]
    numbers = sorted(int(each.rpartition("_v")[2]) for each in found)
    return [f"{name}_v{number}" for number in numbers]


def current(spark: SparkSession, name: str) -> str | None:
    """The version that the view shows; versions beyond it were never finished."""
    database, _, table = name.rpartition(".")
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()["data_type"]
    return f"{database}.{table}_v{text.rpartition('_v')[2]}"


def _write_version(fact: DataFrame, name: str, buckets: int) -> None:
    spark = fact.sparkSession
    shown, known = current(spark, name), versions(spark, name)
    for left in known[known.index(shown) + 1 if shown else 0 :]:  # written by a job that was lost before its end
        spark.sql(f"DROP TABLE {left}")
    database, _, table = name.rpartition(".")
    folder = spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'").first()["info_value"]
    number = int(shown.rpartition("_v")[2]) + 1 if shown else 1
    while exists(spark, f"{folder}/{table.lower()}_v{number}"):  # files of a job that was lost while writing
        number += 1
    (
        fact.select(*FACT.names).write.format("parquet").option("compression", CODEC).partitionBy(*FACT_PARTITIONS)
        .bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(f"{name}_v{number}")
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v{number}")


def write_bucketed(fact: DataFrame, name: str, buckets: int, dealt: bool = False) -> None:
    """Full load: one exchange by key, in as many tasks as buckets, so a month gets a file per bucket.
    ``dealt`` tells that the rows lie so already (``silver_trips`` with ``buckets``)."""
    _write_version(fact if dealt else fact.repartition(buckets, KEY), name, buckets)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*FACT.names)


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'")
    return int(rows.first()["data_type"])


def merged(spark: SparkSession, name: str, batch: DataFrame) -> DataFrame:
    """Delete by key and insert. Only the batch is exchanged, to the buckets of the stored side."""
    shown = current(spark, name)
    dealt = batch.select(*FACT.names).repartition(bucket_count(spark, shown), KEY)
    return delete_insert(spark.table(shown).select(*FACT.names).hint("merge"), dealt, [KEY])


def upsert_bucketed(spark: SparkSession, name: str, batch: DataFrame) -> None:
    """Writes the next version. The batch is staged, because keys and rows of it are read.

    Before buckets outgrow twice the memory that they are meant for, the rows are dealt to more of them.
    """
    staged, shown = stage(batch, "bucketed-batch"), current(spark, name)
    buckets, wanted = bucket_count(spark, shown), buckets_of(spark.table(shown).count() + staged.count())
    if wanted > 2 * buckets:
        target = spark.table(shown).select(*FACT.names).repartition(wanted, KEY)
        rows = delete_insert(target, staged.select(*FACT.names).repartition(wanted, KEY), [KEY])
        return write_bucketed(rows, name, wanted)
    _write_version(merged(spark, name, staged), name, buckets)


def drop_old(spark: SparkSession, name: str) -> list[str]:
    """Drops the versions before the one shown; not while a reader is still on one."""
    shown = current(spark, name)
    old = versions(spark, name)
    old = old[: old.index(shown)] if shown in old else []
    for each in old:
        spark.sql(f"DROP TABLE {each}")
    return old


def repeated_keys(spark: SparkSession, name: str) -> DataFrame:
    """Keys stored more than once, with their rows: an aggregate inside the buckets."""
    counts = spark.table(name).groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter("rows > 1")
