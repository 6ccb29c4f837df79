"""Connected components by repeated contraction: every node takes its least neighbour's name.

Node names are hashes, so the least neighbour is a random one and each pass merges a constant share of
the nodes that are left. Only the count of remaining edges goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spark import stored


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp) of every row of ``nodes`` (node); ``edges`` (a, b) may repeat and be loops."""
    labels = nodes.select("node", F.col("node").alias("comp"))
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionAll(edges.select("b", "a"))
        parents = stored(
            both.groupBy(F.col("a").alias("child"))
            .agg(F.min("b").alias("low"))
            .select("child", F.least("child", "low").alias("parent")),
            "parents",
        )
        labels = stored(
            labels.join(parents, labels["comp"] == parents["child"], "left").select(
                "node", F.coalesce("parent", "comp").alias("comp")
            ),
            "labels",
        )
        first, second = (
            parents.select(F.col("child").alias(end), F.col("parent").alias(f"to_{end}")) for end in "ab"
        )
        moved = edges.join(first, "a").join(second, "b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        )
        edges = stored(moved.where("a <> b").distinct(), "edges")
    return labels
