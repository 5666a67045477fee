"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.text import Stages
from tripflow.session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for links ``a``, ``b``.

    Each round takes the least label of all neighbours and then the label of that label, so a chain
    shrinks to a fraction; rounds end when no label changes. Labels are written to the shared folder, and those of a
    round go when the next ones stand.
    """
    held = Stages(links.sparkSession)
    edges = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct()
    edges = held(edges, "edges")
    labels = held(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels 0")
    number = 0
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "other"), "other")
        least = seen.groupBy("node").agg(F.min("component").alias("least"))
        lowered = labels.join(least, "node").select("node", F.least("component", "least").alias("component"), F.col("component").alias("was"))
        target = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        lowered = lowered.join(target, "component", "left")
        step = F.least("component", F.coalesce("next", "component"))
        number += 1
        labels_next = held(lowered.select("node", step.alias("component"), (step != F.col("was")).alias("moved")), f"labels {number}")
        labels = labels_next.select("node", "component")
        if labels_next.filter("moved").isEmpty():
            result = stage(labels, "components")
            held.drop()
            return result
        held.drop("edges", f"labels {number}")
