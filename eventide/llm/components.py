"""Connected components of an edge table by alternating large-star and small-star joins.

Each round is a handful of hash joins and aggregates with map-side combine; a
node with very many neighbours is one side of a join that Spark can split, not
a group in one task.  Lineage is cut after every round, in the folder that all
executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the least node of its component) for every node of ``edges`` (longs ``a, b``)."""
    current = cut_lineage(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _only_stars(current):
        current = cut_lineage(_small_star(_large_star(current)))
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least one among the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them (edges run from larger to smaller)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node points to one root and no root points on."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    open_ends = ends.groupBy("n").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where(
        "out > 1 OR (out > 0 AND into > 0)"
    )
    return open_ends.isEmpty()
