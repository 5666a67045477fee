"""Raw monthly files: naming rule, scan under the bronze contract, and file audit."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.contracts import BRONZE_PARTITIONS, DATASETS, MIN_FILE_BYTES, RAW
from tripflow.functions import to_integral
from tripflow.periods import check_period
from tripflow.sources.footers import filled_counts

# Fixed value: the name of a raw month. Spark may have written it as a folder of part files.
NAME_FORMAT = "{dataset}_tripdata_{year}-{month:02d}.parquet"
NAME_PATTERN = r"([a-z]+_tripdata_(\d{4})-(\d{2})\.parquet)"


def landing_name(year: int, month: int, dataset: str = "yellow") -> str:
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}, expected one of {DATASETS}")
    return NAME_FORMAT.format(dataset=dataset, year=year, month=month)


def landing_path(root: str, year: int, month: int, dataset: str = "yellow") -> str:
    return f"{root.rstrip('/')}/{dataset}/{landing_name(year, month, dataset)}"


def stamp(moment: datetime | str | None = None) -> Column:
    """Ingestion time as a zone-less UTC literal in whole seconds."""
    if not isinstance(moment, str):
        moment = (moment or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(moment))


def contract_columns(raw: DataFrame) -> list[Column]:
    """The contract's columns, in order and cast; extras go, a missing one is an error."""
    found = {field.name.lower(): field for field in raw.schema.fields}
    missing = [name for name in RAW.names if name.lower() not in found]
    if missing:
        raise ValueError(f"raw data lacks contract columns {missing}")
    columns = []
    for field in RAW.fields:
        source = found[field.name.lower()]
        value = F.col(f"`{source.name}`")
        if isinstance(field.dataType, T.IntegralType):
            value = to_integral(value, source.dataType, field.dataType)
        else:
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return columns


def scan_month(
    spark: SparkSession,
    root: str,
    year: int,
    month: int,
    dataset: str = "yellow",
    ingested_at: datetime | str | None = None,
) -> DataFrame:
    """One raw month as bronze rows. A missing file fails when the path is resolved.

    Every month is read under its own file schema, because types drift between
    deliveries, and the lineage columns are literals that cost nothing per row.
    """
    check_period(year, month)
    raw = spark.read.parquet(landing_path(root, year, month, dataset))
    return raw.select(
        *contract_columns(raw),
        stamp(ingested_at).alias("_ingested_at"),
        F.lit(landing_name(year, month, dataset)).alias("_source_file"),
        F.lit(year).alias("_year"),
        F.lit(month).alias("_month"),
    )


def read_landing(
    spark: SparkSession,
    *paths: str,
    dataset: str = "yellow",
    ingested_at: datetime | str | None = None,
) -> DataFrame:
    """Many raw months of one dataset, one scan per physical schema that occurs among them.

    Deliveries drift, so every month's schema is looked up (one footer each) and held against the
    contract before anything is read: a month that lacks a column fails by name. Lineage comes from
    the paths by plain substrings, since it is computed per row; a path that does not follow the
    naming rule fails the cast to a year.
    """
    prefix = landing_name(0, 0, dataset).partition("0-")[0]
    length = len("YYYY-MM.parquet")
    scans = []
    for months in months_by_schema(spark, *paths):
        raw = spark.read.parquet(*months)
        suffix = F.substring_index("_metadata.file_path", prefix, -1).alias("suffix")
        try:
            columns = contract_columns(raw)
        except ValueError as error:
            raise ValueError(f"{error}, in {', '.join(months)}") from error
        scans.append(raw.select(*columns, suffix))
    stamped = stamp(ingested_at).alias("_ingested_at")
    return reduce(DataFrame.unionAll, scans).select(
        *RAW.names,
        stamped,
        F.expr(f"concat('{prefix}', left(suffix, {length}))").alias("_source_file"),
        F.expr("cast(left(suffix, 4) AS int)").alias("_year"),
        F.expr("cast(substr(suffix, 6, 2) AS int)").alias("_month"),
    )


def months_by_schema(spark: SparkSession, *paths: str) -> list[list[str]]:
    """Paths of the raw months found, grouped by schema. At most 12 months a year come to the driver."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        .select(F.regexp_extract("path", f"^(.*{NAME_PATTERN})", 1).alias("month"))
        .filter("month != ''").distinct()
    )
    months = sorted(row["month"] for row in found.collect())
    if not months:
        raise ValueError(f"no raw months under {', '.join(paths)}")
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda month: spark.read.parquet(month).schema.json(), months))
    groups: dict[str, list[str]] = {}
    for month, schema in zip(months, schemas, strict=True):
        groups.setdefault(schema, []).append(month)
    return list(groups.values())


def landing_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Part files of raw months under the paths. Contents are not read: the binary source
    opens a file only when ``content`` is selected."""
    source_file = F.regexp_extract("path", NAME_PATTERN, 1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select(
            source_file.alias("_source_file"),
            F.regexp_extract("path", NAME_PATTERN, 2).alias("year_text"),
            F.regexp_extract("path", NAME_PATTERN, 3).alias("month_text"),
            "length",
        )
        .filter(F.col("_source_file") != "")
        .select(
            "_source_file",
            F.col("year_text").cast("int").alias("_year"),
            F.col("month_text").cast("int").alias("_month"),
            "length",
        )
    )


def bronze_manifest(bronze: DataFrame, dataset: str = "yellow") -> DataFrame:
    """Names of the raw months a bronze table holds. A month is one partition, so only partition
    values are read, no column of any row; ``sources.footers`` counts them without a scan."""
    name = F.concat(
        F.lit(landing_name(0, 0, dataset).partition("0-")[0]),
        F.col("_year"), F.lit("-"), F.lpad(F.col("_month").cast("string"), 2, "0"), F.lit(".parquet"),
    )
    return filled_counts(bronze, BRONZE_PARTITIONS, []).select(name.alias("_source_file"))


def audit_landing(
    spark: SparkSession,
    *paths: str,
    loaded: DataFrame | None = None,
    expected: DataFrame | None = None,
    min_bytes: int = MIN_FILE_BYTES,
) -> DataFrame:
    """One row per raw month found under the paths, from file sizes alone.

    Spark's file sources pass over files of zero bytes. Name the months that should be there
    in ``expected`` (any frame with ``_source_file``) to see missing and empty ones as 0 bytes.

    ``action`` is ``fetch`` for an empty or undersized delivery, ``skip`` for one that is
    already in ``loaded`` (any frame with ``_source_file``) and ``load`` for the rest.
    """
    audit = (
        landing_files(spark, *paths).groupBy("_source_file").agg(F.sum("length").alias("bytes"))
    )
    if expected is not None:
        wanted = expected.select("_source_file").distinct()
        audit = wanted.join(audit, "_source_file", "full").select(
            "_source_file", F.coalesce("bytes", F.lit(0)).alias("bytes")
        )
    if loaded is None:
        audit = audit.withColumn("already_loaded", F.lit(False))
    else:
        manifest = loaded.select("_source_file").distinct().withColumn("_loaded", F.lit(True))
        audit = audit.join(manifest, "_source_file", "left").select(
            "_source_file", "bytes", F.coalesce("_loaded", F.lit(False)).alias("already_loaded")
        )
    return audit.select(
        "*",
        (F.col("bytes") == 0).alias("is_empty"),
        (F.col("bytes") < min_bytes).alias("below_minimum"),
        F.when(F.col("bytes") < min_bytes, "fetch")
        .when(F.col("already_loaded"), "skip")
        .otherwise("load")
        .alias("action"),
    )
