"""Connected components of a graph given as edges, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every node of (a, b): the least node that can be reached.

    Each round gives a node the least label among its neighbours and then the label of its label, so that labels
    travel twice as far with each round. Every round is written to the scratch folder.
    """
    both = scratch.keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = scratch.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
        lower = labels.join(near.agg(F.min("component").alias("near")), "id").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("step")
        )
        further = labels.select(F.col("id").alias("step"), F.col("component").alias("component"))
        after = scratch.keep(lower.join(further, "step").select("id", "component", "before"))
        labels = after.select("id", "component")
        if after.where("component <> before").isEmpty():
            return labels
