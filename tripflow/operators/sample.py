from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 4096


def sample_rows(rows: DataFrame, cap: int, seed: int = 0) -> DataFrame:
    """``cap`` rows drawn uniformly, or all rows of a smaller table.

    Every row gets a random number, and the lowest ``cap`` stay. Where to cut is found by histograms of the
    numbers: ``SLOTS`` counts, then as many inside the slot that holds the ``cap``-th, until a slot has
    no more than ``SLOTS`` rows. What lies below is a filter, whatever the cap; only the rows of that last slot
    are put in order. Counting reads no column. Numbers depend on the order of rows in a task, which is
    repeatable for stored tables; stage the result of a shuffle first.
    """
    drawn = rows.withColumn("_draw", F.rand(seed))
    low, width, wanted = 0.0, 1.0, cap
    while True:
        slot = F.floor((F.col("_draw") - low) / (width / SLOTS)).cast("int")
        inside = drawn.filter((F.col("_draw") >= low) & (F.col("_draw") < low + width))
        counts = dict(inside.groupBy(slot.alias("slot")).count().collect())  # SLOTS rows at most
        if sum(counts.values()) <= wanted:  # all that is left: only when the table is not larger than the cap
            return drawn.filter(F.col("_draw") < low + width).drop("_draw")
        at = 0
        while counts.get(at, 0) <= wanted:
            wanted -= counts.get(at, 0)
            at += 1
        low, width = low + at * (width / SLOTS), width / SLOTS
        if counts[at] <= SLOTS or width < 1e-12:
            break
    below = drawn.filter(F.col("_draw") < low)
    last = drawn.filter((F.col("_draw") >= low) & (F.col("_draw") < low + width))
    return below.union(last.orderBy("_draw").limit(wanted)).drop("_draw")
