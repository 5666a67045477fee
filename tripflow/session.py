"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sized for executors of about 4 GB per core. AQE merges reduce partitions but splits only those of
# joins and rebalances, not those below a window or an aggregate, so a job over many terabytes sets
# ``spark.sql.shuffle.partitions`` to ``shuffle_partitions`` of its input.
PARTITION_BYTES = 256 << 20
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def shuffle_partitions(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Partitions of a shuffle of the whole input: 400,000 for 100 TB."""
    return max(200, -(-input_bytes // partition_bytes))


def local_session(name: str, cores: str = "*", **conf: str) -> SparkSession:
    settings = CLUSTER_CONF | {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripflow-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/tripflow/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes what ``stage`` or a sink wrote for the time of one job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back, so that several consumers share the work.

    The files outlive lost executors, and the lineage of what follows starts at them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
