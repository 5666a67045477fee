"""Silver trips: renamed, typed, range-checked, one row per trip.

Wide projections are written as SQL text: one expression costs one call into the JVM, where
a chain of Column methods costs several.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.contracts import (
    BRONZE,
    CLEAN_NAMES,
    SILVER,
    SILVER_RANGES,
    TIE_BREAK,
    TRIP_KEY,
)
from tripflow.functions import surrogate_key

# The trip key with its most selective column in front.
DEDUP_KEY = sorted(TRIP_KEY, key=lambda name: name != "pickup_datetime")

Ranges = Mapping[str, tuple[float, float]]


def in_periods(bronze: DataFrame, periods: Iterable[tuple[int, int]]) -> DataFrame:
    """Prunes bronze to some (year, month) partitions, before any deduplication."""
    wanted = [f"(_year = {int(year)} AND _month = {int(month)})" for year, month in periods]
    return bronze.filter(" OR ".join(wanted) or "false")


def rename_trips(bronze: DataFrame) -> DataFrame:
    types = {field.name: field.dataType.simpleString() for field in SILVER.fields}
    names = {raw: CLEAN_NAMES.get(raw, raw) for raw in BRONZE.names}
    return bronze.selectExpr(
        *[f"CAST({raw} AS {types[clean]}) AS {clean}" for raw, clean in names.items()]
    )


def valid_trips(trips: DataFrame, ranges: Ranges = SILVER_RANGES) -> DataFrame:
    """Both timestamps present and every ranged amount inside; NULL and NaN amounts fail."""
    present = [f"{name} IS NOT NULL" for name in ("pickup_datetime", "dropoff_datetime")]
    ranged = [f"{name} BETWEEN {low}D AND {high}D" for name, (low, high) in ranges.items()]
    return trips.filter(" AND ".join(present + ranged))


def keep_latest(
    rows: DataFrame, keys: Sequence[str], latest: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key; NULL keys form groups of their own.

    Ranking for rank 1 lets Spark cut every key to one row per map task before the shuffle
    (WindowGroupLimit), so a key with very many copies never lands whole in one task. Put
    the most selective key first: Spark's sort compares by a prefix of its first column.
    """
    order = [f"{latest} DESC NULLS LAST", *[f"{name} ASC NULLS LAST" for name in tie_break]]
    rank = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return rows.withColumn("_rank", F.expr(rank)).filter("_rank = 1").drop("_rank")


def hot_keys(rows: DataFrame, keys: Sequence[str], share: float = 1e-3) -> list[int]:
    """Hashes of the keys that make up more than ``share`` of the rows, at most 1 / ``share`` of them.

    Found by a sketch in one pass, without a shuffle of rows; a key with fewer rows may be among them.
    """
    hashes = rows.select(F.xxhash64(*keys).alias("hash"))
    sketch = hashes.agg(F.count(F.lit(1)).alias("rows"), F.expr("approx_top_k(hash, 1000, 16000)").alias("top")).first()
    return [item["item"] for item in sketch["top"] or [] if item["count"] > max(share * sketch["rows"], 1000)]


def latest_placed(
    rows: DataFrame,
    place: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    latest: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``keep_latest`` for rows that are written next: one exchange, ``place`` (by ranges or hashes of some of
    ``keys``), serves the deduplication and the layout. Copies are not cut before it, so the keys with very
    many copies go the other way.
    """
    hot = hot_keys(rows, keys)
    placed = lambda some: keep_latest(place(some), keys, latest, tie_break)
    if not hot:
        return placed(rows)
    is_hot = F.xxhash64(*keys).isin(hot)
    return placed(rows.filter(~is_hot)).unionByName(keep_latest(rows.filter(is_hot), keys, latest, tie_break))


def tie_break_for(columns: Iterable[str]) -> list[str]:
    """The part of the tie-break order that can change the values of ``columns``.

    Rows equal on that prefix agree on every wanted column, so later entries, and the
    shuffle of them, are needless.
    """
    positions = [TIE_BREAK.index(name) for name in columns if name in TIE_BREAK]
    return TIE_BREAK[: max(positions, default=-1) + 1]


def silver_trips(
    bronze: DataFrame,
    periods: Iterable[tuple[int, int]] | None = None,
    columns: Sequence[str] | None = None,
    ranges: Ranges = SILVER_RANGES,
    by_time: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Bronze to silver with one shuffle.

    ``periods`` prunes partitions first; copies of a trip in other periods are then not
    seen. ``columns`` asks for a subset and narrows what is shuffled and sorted. ``by_time``
    leaves the rows in ranges of pickup time, ``buckets`` in so many parts by ``trip_id``, ready to be written.
    """
    if periods is not None:
        bronze = in_periods(bronze, periods)
    columns = list(columns or SILVER.names)
    trips, order = valid_trips(rename_trips(bronze), ranges), ["_ingested_at", tie_break_for(columns)]
    if by_time:
        trips = latest_placed(trips, lambda rows: rows.repartitionByRange(*DEDUP_KEY), DEDUP_KEY, *order)
    elif buckets:
        trips = trips.withColumn("trip_id", surrogate_key(*TRIP_KEY))
        deal = lambda rows: rows.repartition(buckets, "trip_id")
        return latest_placed(trips, deal, ["trip_id", *DEDUP_KEY], *order).select(*columns)
    else:
        trips = keep_latest(trips, DEDUP_KEY, *order)
    return trips.select(
        *[surrogate_key(*TRIP_KEY).alias(name) if name == "trip_id" else name for name in columns]
    )
