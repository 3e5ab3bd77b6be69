"""Connected components by contraction, with every step a shuffle and nothing collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component, the least node reachable, for every node of an edge table with bigint columns a and b.

    Each round points a node to its least neighbour, follows the pointers of
    pointers, and replaces the nodes of the remaining edges by where they
    point. A pointer always leads to a lesser node, so what a group
    becomes is its least member. Every round leaves at most half of the nodes.
    """
    spark = edges.sparkSession
    total = None
    left = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("component")), "pointers")
        for _ in range(3):
            ahead = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
            step = step.join(ahead, "component").select("node", F.col("further").alias("component"))
        step = stored(step, "pointers")
        if total is None:
            total = step
        else:
            ahead = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
            total = stored(total.join(ahead, "component", "left").select(
                "node", F.coalesce("further", "component").alias("component")), "components")
        of = lambda side: step.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        left = stored(left.join(of("a"), "a").join(of("b"), "b").where("of_a <> of_b").select(
            F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct(), "edges")
    return total if total is not None else spark.createDataFrame([], "node bigint, component bigint")
