"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchspark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of all nodes of edges (a, b).

    Labels start as the nodes themselves; each round a node takes the least
    label around it and then that label's own label (pointer jumping). Partial
    minima travel, never a node's neighbours; rounds end when none changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "graph-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "graph-labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        mine = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("root"))
        moved = materialize(mine.join(jump, "now", "left").select("node", "was", F.least("now", F.coalesce("root", "now")).alias("component")), "graph-labels")
        changed = not moved.where("was <> component").isEmpty()
        labels = moved.select("node", "component")
        if not changed:
            return labels
