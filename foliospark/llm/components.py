"""Connected components by repeated contraction, on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import drop, durable


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node) for every node of an edge.

    Each round maps a node to the least node of its neighbourhood, follows that map once more and
    contracts the edges; rounds end when no edge is left. Counts of a node's edges are summed
    before they are shuffled, so a node with very many edges is no hot key.
    """
    edges = durable(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("component"))
    live = edges.where("a < b")
    old = []
    while not live.isEmpty():
        both = live.select("a", "b").union(live.select("b", "a"))
        step = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m"))
        first = durable(step)
        jump = first.select(F.col("v").alias("w"), F.col("m").alias("mm"))
        step = durable(first.join(jump, F.col("m") == F.col("w"), "left").select("v", F.coalesce("mm", "m").alias("m")))
        labels = durable(labels.join(step, F.col("component") == F.col("v"), "left").select("node", F.coalesce("m", "component").alias("component")))
        to = step.select(F.col("v").alias("v2"), F.col("m").alias("m2"))
        live = live.join(step, F.col("a") == F.col("v")).join(to, F.col("b") == F.col("v2"))
        live = durable(live.select(F.least("m", "m2").alias("a"), F.greatest("m", "m2").alias("b")).where("a < b").distinct())
        drop(first, step, *old)  # read by nothing any more
        old = [labels, live]
    return labels
