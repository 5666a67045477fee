"""A uniform random shuffle into shards of exact size, planned by a communication matrix.

How many rows of input partition p go to shard j, over all permutations of the corpus, follows a
hypergeometric law. The matrix of these counts follows from the partition sizes alone, by halves: of the rows
that all partitions of a range put into each shard, one draw says how many come from its first half,
and so on down to one partition. The draws of a range have a seed of their own, so every task finds its own row
of the matrix by itself, in as many steps as the number of tasks has bits. Given its row, every partition permutes its own labels, the rows are exchanged, and a second permutation
orders each shard; together that is a uniform permutation of all rows, and no shard is ever off by a
row. The exchange is a range sort by (shard, random key), so a shard may span many tasks.

The driver gets one number per input partition, and hands these to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.text import bounded_batches, packed, table, whole
from tripflow.session import stage

SHARDS = 24
SEED = 20
TRIES = 3
RECOUNT = "rows in a partition than were counted"


def hypergeometric(good: int, bad: int, drawn: int, rng: np.random.Generator) -> int:
    """How many of ``drawn`` balls are good. By inversion around the mean, for urns of any size."""
    total = good + bad
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mean = drawn * good / total
    spread = (mean * (bad / total) * ((total - drawn) / max(total - 1, 1))) ** 0.5
    first = max(low, int(mean - 12 * spread) - 30)
    k = np.arange(first, min(high, int(mean + 12 * spread) + 30), dtype=float)
    step = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    law = np.concatenate([[0.0], np.cumsum(step)])
    law = np.cumsum(np.exp(law - law.max()))
    return first + int(np.searchsorted(law, rng.random() * law[-1], side="right"))


def split(room: list[int], drawn: int, rng: np.random.Generator) -> list[int]:
    """How many of ``drawn`` rows lie in each shard, of all that have this room: one draw after the other."""
    rest, taken = sum(room), []
    for size in room:
        rest -= size
        taken.append(hypergeometric(size, rest, drawn, rng))
        drawn -= taken[-1]
    return taken


def row_of(ends: list[int], part: int, shards: int, seed: int = SEED) -> list[int]:
    """Rows of one partition per shard; ``ends`` are running sums of the partition sizes. Shard sizes differ by
    one at most."""
    room = [ends[-1] // shards + (j < ends[-1] % shards) for j in range(shards)]
    low, high = 0, len(ends)
    while high - low > 1:
        middle = (low + high) // 2
        before = ends[low - 1] if low else 0
        first = split(room, ends[middle - 1] - before, np.random.default_rng([seed, low, high]))
        if part < middle:
            room, high = first, middle
        else:
            room, low = [size - taken for size, taken in zip(room, first, strict=True)], middle
    return room


def running_sums(parts: list[int]) -> list[int]:
    return np.cumsum(parts, dtype=np.int64).tolist()


def communication_matrix(parts: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Rows per (partition, shard), for looking at it as a whole."""
    ends = running_sums(parts)
    return np.array([row_of(ends, part, shards, seed) for part in range(len(parts))], dtype=np.int64).reshape(-1, shards)


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows as struct ``row`` with ``shard`` (0 to shards - 1) and ``slot``, gapless from 0.

    Contents play no part: NULLs, equal rows and any columns are shuffled like others. With fewer
    rows than shards the last shards are empty; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    for attempt in range(TRIES):
        try:
            return placed_rows(packed(docs), shards, seed + attempt)
        except PythonException as error:
            if RECOUNT not in str(error) or attempt + 1 == TRIES:
                raise


def placed_rows(held: DataFrame, shards: int, seed: int) -> DataFrame:
    """One attempt. The scan may be split otherwise when it runs again (executors came or went); a task
    that finds other rows than were counted ends it."""
    counts = held.groupBy(F.spark_partition_id().alias("part")).count().collect()  # a row per task
    sizes = {row["part"]: row["count"] for row in counts}
    order = sorted(sizes)
    ends = running_sums([sizes[part] for part in order])
    shared = held.sparkSession.sparkContext.broadcast(({part: k for k, part in enumerate(order)}, ends))
    schema = T.StructType(
        held.schema.fields + [T.StructField("shard", T.IntegerType()), T.StructField("draw", T.LongType())]
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, labels = 0, None
        for batch in batches:
            if labels is None:  # the column says where the rows were counted, whoever asks for them
                part = batch.column(1)[0].as_py()
                places, running = shared.value
                if part not in places:
                    raise RuntimeError(f"more {RECOUNT}")
                rng = np.random.default_rng([seed, 1, part, shards])
                labels = np.repeat(np.arange(shards, dtype=np.int32), row_of(running, places[part], shards, seed))
                rng.shuffle(labels)
            own = labels[at : at + batch.num_rows]
            at += batch.num_rows
            if at > len(labels):
                raise RuntimeError(f"more {RECOUNT}")
            draw = rng.integers(-(2**63), 2**63 - 1, batch.num_rows)
            columns = [batch.column(0), pa.array(own), pa.array(draw)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if at and at < len(labels):
            raise RuntimeError(f"fewer {RECOUNT}")

    exchanged = stage(
        held.withColumn("part", F.spark_partition_id())
        .mapInArrow(label, schema)
        .repartitionByRange("shard", "draw")
        .sortWithinPartitions("shard", "draw")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33)),
        "shards",
    )
    # One row per task and shard it touches, at most tasks + shards of them.
    runs = exchanged.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = F.expr(
        "coalesce(sum(rows) OVER (PARTITION BY shard ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    runs = runs.select("shard", "part", (before - F.col("first")).alias("shift"))
    placed = exchanged.join(F.broadcast(runs), ["shard", "part"])  # tasks + shards rows of three numbers
    return placed.select("row", "shard", (F.col("at") + F.col("shift")).alias("slot"))


def byte_size(text: Column) -> Column:
    return (F.octet_length(whole(text)) + 8).cast("long")


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.col("row.text")
    return shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id",
        byte_size(text).alias("size"),
        F.crc32(whole(text).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
