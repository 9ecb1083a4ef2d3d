"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.staging import stage


def _toward_smallest(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours linked to the smallest of them.

    The minimum is summed up before it is shuffled, and comes back by a join that Spark may split, so a
    node with very many neighbours is handled by many tasks.
    """
    low = pairs.groupBy("u").agg(F.min("v").alias("_least"))
    moved = pairs.join(low, "u").select(F.col("v").alias("u"), F.col("_least").alias("v"))
    return moved.unionByName(low.select("u", F.col("_least").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Large star (all larger neighbours to the smallest) and small star (all smaller ones and the node itself)
    alternate until all edges form stars, in about log(nodes) rounds. Each round is a table in the shared folder.
    """
    ends = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stage(ends.distinct())
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_least")).withColumn("_least", F.least("u", "_least"))
        larger = both.filter("v > u").join(low, "u")
        large = larger.select(F.col("v").alias("u"), F.col("_least").alias("v")).distinct()
        edges = stage(_toward_smallest(stage(large)))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    nodes, rows = edges.agg(F.count_distinct("u"), F.count("*")).first()
    if nodes != rows:
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
