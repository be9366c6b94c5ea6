"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetwatt.llm.steps import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each node of an edge reaches.

    Large star: every larger neighbour of a node is linked to the node's least neighbour. Small
    star: the smaller ones are. Both only need the least neighbour, so a hub with most nodes is a
    skewed join with one row on the other side and never a group in one task. Each round is stored
    in the shared folder. Loops, repeated edges and edges with a NULL end are left out.
    Rounds: about the logarithm of the longest path.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    now, before = stored(edges, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        now = stored(small.distinct(), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return least.unionByName(least.select(F.col("component").alias("node"), "component").distinct())
