"""What several operators share: reading tables and splitting texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import drop_path, scratch_path

# Fixed value: the white space of all contracts, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Fewer rows per Arrow batch, where the session has left Spark's default: rows hold whole texts."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, rows)


def whole(text: Column) -> Column:
    """The text, with NULL as empty."""
    return F.coalesce(text, F.lit(""))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``docs`` as one struct ``row`` beside own columns, so that no name can clash."""
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        *[column.alias(name) for name, column in columns.items()],
    )


class Stages:
    """Tables written to the shared folder for the time of one operator. What follows one starts at its files, so
    those before it can go: ``drop`` deletes all but the tables named, by their labels."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *kept: str) -> None:
        for label in [label for label in self.paths if label not in kept]:
            for path in self.paths.pop(label):
                drop_path(self.spark, path)
