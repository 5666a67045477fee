from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.fact import packed, unpacked


def delete_insert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], replaced: DataFrame | None = None
) -> DataFrame:
    """Target rows whose key is not in the batch, then all rows of the batch.

    Only distinct keys of the batch meet the target, so a key repeated many times in the
    batch costs one row; a NULL key deletes nothing. ``replaced`` are those keys where a caller
    has written them: from files Spark knows their size before it plans, and when they are few
    the wide target is not shuffled.
    """
    if replaced is None:
        replaced = batch.select(*key).distinct()
    return target.join(replaced, list(key), "left_anti").unionByName(batch)


# A trip's key is made of these fact columns.
KEY_COLUMNS = ["pickup_datetime", "dropoff_datetime", "vendor_id", "pickup_location_id"]


def delete_insert_facts(target: DataFrame, batch: DataFrame, key: str = "trip_id") -> DataFrame:
    """``delete_insert`` of facts with one exchange, which also brings the rows into ranges of pickup time.

    Equal keys share the columns they are made of, so rows are dealt by ranges of those, without the columns
    that others give. Target rows beside a row of the batch go; all rows of the batch stay, and a NULL key
    deletes nothing.
    """
    names = batch.columns
    both = target.select(*names).withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    rows = unpacked(packed(both).repartitionByRange(*KEY_COLUMNS))
    newest = F.expr(f"max(_new) OVER (PARTITION BY {', '.join([*KEY_COLUMNS, key])})")
    kept = rows.withColumn("_newest", newest).filter(f"_new = 1 OR _newest = 0 OR {key} IS NULL")
    return kept.select(*names)
