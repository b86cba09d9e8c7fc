"""Connected components of a distributed edge list by alternating large and small stars.

Nothing is gathered on the driver: each round is four aggregations and joins on node ids, its edges go to
the shared checkpoint folder, and the rounds end when all edges are stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.session import checkpointed


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with a link to another; the component is the smallest reachable node.

    ``links`` has two columns of longs; nulls and self-links are ignored, repeats and either direction are fine.
    """
    a, b = links.columns
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")).where("u <> v").distinct()
    edges = checkpointed(edges)
    for _ in range(max_rounds):
        if _are_stars(edges):
            roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.unionByName(floor.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    through = edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return not twice.unionByName(through).limit(1).count()
