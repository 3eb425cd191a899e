"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; nulls are skipped).

    component is the smallest node of the component. Every round takes the
    smallest label among the neighbours (a map-side combined aggregation, so a
    hub is no single task's work) and then follows labels one step, which
    shortens chains by half. Labels are written each round; no edge, label or
    component reaches the driver, only the count of changed labels.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = scratch.keep(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "labels0")
    step = 0
    while True:
        known = labels.select(F.col("node").alias("a"), "component")
        near = both.join(known, "a").groupBy(F.col("b").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        target = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = lower.join(target, "component").select("node", "old", F.least("component", "next").alias("component"))
        step += 1
        after = scratch.keep(after, f"labels{step}")
        changed = after.where("component <> old").limit(1).count()
        scratch.drop(f"labels{step - 1}")
        labels = after.select("node", "component")
        if not changed:
            scratch.drop("edges")
            return labels
