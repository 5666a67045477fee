"""Mixing sources to target token counts by entropy balancing.

Every document has a rate, the expected number of its copies. Among all rates that give each source
its target of tokens, the mix takes those closest to 1 in relative entropy, where a document counts
as ``1 + size / mean size`` units (so long documents are not traded away for short ones). The convex
dual has one multiplier per source, and its solution tilts the rates exponentially:

    rate = min(cap, exp(multiplier * x)),   x = (size / mean) / (1 + size / mean)

Newton steps find the multipliers. A step is one distributed aggregate over the histogram of
(source, size), which stands for all documents exactly. Sums are taken in decimals, so they do not
depend on the order of tasks and a rerun gives the same copies.

Rates become whole copies per histogram cell, going from the largest size down: a cell of n documents
gets the whole number of copies next to n * rate and the rounding error so far, in tokens, and passes
its own error on. Each of its documents gets its rate rounded down or up. A source with T tokens has at
most sqrt(2 T) distinct sizes, which bounds that sequential pass.
The documents of a cell that get the extra copy are its first ones by hash of the id; their places
come from a range sort, never from a window over a cell, so a cell may hold any share of the rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.text import SPACE, Stages, packed, table, whole
from tripflow.session import stage

CAP = 3
WEIGHTS = (1, 2, 3)
STEPS = 200
TOLERANCE = 1e-7
LIMIT = 1e15


def source_targets(totals: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to ``source``, ``source_size``: weights by order of name, capped, the rest reshared.

    Full sources are a prefix of the order by cap per weight. Were the first k of them full, the rest
    would share at a level that rises with k as long as source k is full and falls after that, so the
    level wanted is the highest. The pass sees one row per source, no documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy("room", F.col("source").asc_nulls_last())
    after = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = totals.withColumn(
        "weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ).withColumn("room", cap * F.col("source_size") / F.col("weight"))
    levels = (
        weighed.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("level", (F.col("all") - F.col("full")) / F.sum("weight").over(after))
        .withColumn("level", F.max("level").over(everything))
    )
    target = F.least(F.col("level") * F.col("weight"), cap * F.col("source_size").cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def tilt_of(size: str = "size", mean: str = "mean"):
    """x of a document; 0 for empty ones and for sources without tokens."""
    scaled = F.coalesce(F.try_divide(F.col(size), F.col(mean)), F.lit(0.0))
    return scaled / (1 + scaled)


def solve_multipliers(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``multiplier`` to the targets: safeguarded Newton on the dual of every source at once.

    ``cells`` has ``source``, ``size``, ``n``. Each step is one aggregate over all cells; what is
    carried from step to step, one row per source, is written to the shared folder. A source whose
    target is its cap has its multiplier at infinity, one without a target at minus infinity. Where a Newton
    step leaves the bracket, it is halved, which ends at the last bit of a double long before ``STEPS``;
    a source still off its target then is an error.
    """
    cells = cells.filter("size > 0")
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    same = F.col("t.source").eqNullSafe(F.col("c.source"))
    full = cap * F.col("source_size") * (1 - 1e-12)
    state = (
        targets.alias("t").join(means.alias("c"), same, "left").select("t.*", "mean")
        .withColumns({
            "multiplier": F.when(F.col("target") >= full, math.inf)
            .when(F.col("target") <= 0, -math.inf)
            .otherwise(0.0),
            "low": F.lit(-LIMIT),
            "high": F.lit(LIMIT),
            "gap": F.lit(math.inf),
        })
    )
    held = Stages(cells.sparkSession)  # a step's state goes when the next one stands
    state = held(state, "step 0")
    exact = lambda column: F.sum(column.cast("decimal(32,6)")).cast("double")
    for step in range(1, STEPS + 1):
        free = F.exp(F.col("multiplier") * F.col("x"))
        tokens = F.col("n") * F.col("size")
        sums = (
            cells.alias("c").join(state.alias("t"), same)
            .select("t.source", "n", "size", "multiplier", tilt_of().alias("x"))
            .groupBy("source")
            .agg(
                exact(tokens * F.least(free, F.lit(float(cap)))).alias("taken"),
                exact(F.when(free < cap, tokens * free * F.col("x")).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - F.try_divide(gap, F.col("slope"))
        inside = (newton > low) & (newton < high)
        fixed = F.col("taken").isNull() | (F.abs(F.col("multiplier")) == math.inf)
        done = fixed | (F.abs(gap) <= TOLERANCE * F.col("target") + 1e-3)
        state = held(
            state.alias("t").join(sums.alias("c"), same, "left")
            .select("t.*", "taken", "slope")
            .withColumns({
                "multiplier": F.when(done, F.col("multiplier"))
                .when(inside, newton)
                .otherwise((low + high) / 2),
                "low": low,
                "high": high,
                "gap": F.when(done, 0.0).otherwise(F.abs(gap)),
            })
            .drop("taken", "slope"),
            f"step {step}",
        )
        held.drop(f"step {step}")
        if state.filter("gap > 0").isEmpty():
            return state.drop("low", "high", "gap")
    missed = [row["source"] for row in state.filter("gap > 0").select("source").collect()]
    raise RuntimeError(f"no multiplier after {STEPS} steps for sources {missed}")


def whole_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies per cell of one source, largest sizes first, the error carried on in tokens."""
    cells = cells.sort_values("size", ascending=False, kind="stable")
    error, copies = 0.0, []
    for n, size, rate in zip(cells["n"], cells["size"], cells["rate"], strict=True):
        wanted = n * rate + (error / size if size else 0)
        taken = min(max(round(wanted), n * math.floor(rate)), n * math.ceil(rate))
        error = (wanted - taken) * size
        copies.append(int(taken))
    return cells.assign(copies=copies)[["source", "size", "n", "copies"]]


def mix(docs: DataFrame, size, source: str = "source", key: str = "doc_id", cap: int = CAP,
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """All rows as struct ``row`` with ``size``, ``source_size``, ``target``, ``copies``.

    ``size`` is a Column of non-negative whole numbers (NULL counts as 0). NULL is a source of its
    own. Documents of size 0 get one copy. No document gets more than ``cap`` copies. Rows with equal
    ids are separate documents. An empty table gives no rows.
    """
    size = F.coalesce(size, F.lit(0)).cast("long")
    sized = packed(docs, source=F.col(source), size=size, draw=F.xxhash64(F.col(key)))
    # (source, size) sorted over all partitions; ``at`` counts rows within one.
    placed = stage(
        sized.repartitionByRange(F.col("source").asc_nulls_last(), "size", "draw")
        .sortWithinPartitions(F.col("source").asc_nulls_last(), "size", "draw")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33)),
        "mix-placed",
    )
    runs = placed.groupBy("source", "size", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("first")
    )
    earlier = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    runs = stage(runs, "mix-runs")
    cells = stage(runs.groupBy("source", "size").agg(F.sum("rows").alias("n")), "mix-cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    solved = solve_multipliers(cells, source_targets(totals, cap, weights), cap)
    same = F.col("c.source").eqNullSafe(F.col("t.source"))
    rate = F.when(F.col("size") == 0, 1.0).otherwise(
        F.least(F.exp(F.round(F.col("multiplier"), 9) * tilt_of()), F.lit(float(cap)))
    )
    rated = cells.alias("c").join(solved.alias("t"), same).select("c.source", "size", "n", rate.alias("rate"))
    counted = rated.groupBy("source").applyInPandas(whole_copies, "source string, size long, n long, copies long")
    cell = F.col("c.source").eqNullSafe(F.col("r.source")) & (F.col("c.size") == F.col("r.size"))
    plan = (
        runs.alias("r").join(counted.alias("c"), cell).select("r.*", "n", "copies").alias("c")
        .join(solved.alias("t"), same).select("c.*", "source_size", "target")
    )
    run = cell & (F.col("c.part") == F.col("r.part"))
    rank = F.col("before") + F.col("at") - F.col("first")
    base = F.expr("copies div n")
    extra = F.when(rank < F.col("copies") - base * F.col("n"), 1).otherwise(0)
    return (
        placed.alias("r").join(plan.alias("c"), run)
        .select("row", F.col("r.size").alias("size"), "source_size", "target", (base + extra).alias("copies"))
    )


def words(text):
    return F.regexp_count(whole(text), F.lit(f"[^{SPACE}]+")).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: rows repeated by their copies, rows without copies gone."""
    mixed = mix(docs, words(F.col("text")))
    repeats = F.explode(F.expr("array_repeat(0, cast(copies AS int))"))
    return mixed.select("row", repeats.alias("copy")).select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    return mix(docs, F.col("size")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
