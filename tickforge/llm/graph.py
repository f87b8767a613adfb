"""Connected components by iterative Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of `edges` (u, v); component is the least node reachable.

    Each round takes the least label of the neighbours and then the label's own label (pointer jumping), so chains
    halve. Labels are written each round; the loop ends when no label changed. Self-loops are allowed; empty edges
    give no rows. A hub's edges meet in partial minima before the shuffle.
    """
    both = scratch.write(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), f"{name}-edges")
    labels = scratch.write(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select("node", F.least("node", "least").alias("component")), f"{name}-0")
    k = 0
    while True:
        k += 1
        told = both.join(labels, both.v == labels.node).groupBy(F.col("u").alias("n")).agg(F.min("component").alias("c"))
        step = labels.join(told, labels.node == told.n).select("node", F.col("component").alias("was"), F.least("component", "c").alias("c"))
        up = labels.select(F.col("node").alias("p"), F.col("component").alias("pc"))
        step = step.join(up, step.c == up.p).select("node", "was", F.least("c", "pc").alias("component"))
        new = scratch.write(step, f"{name}-{k}")
        done = new.where("component <> was").isEmpty()
        labels = new.select("node", "component")
        scratch.drop(f"{name}-{k - 1}")
        if done:
            return labels
