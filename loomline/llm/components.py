"""Connected components of an edge table by alternating large-star and small-star steps.

Defined cases: edges with a null end and edges of a node with itself join nothing and name no node; repeated edges and
edges in both directions count once; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or it and the smaller ones) are linked to its least neighbour."""
    if large:
        near = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))  # partial sums of a hub are made before the shuffle
    joined = near.join(least, "u")  # the hub's side is split by adaptive execution
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, root: the least node of its component, for each node with an edge."""
    edges = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b").distinct())  # a null end is no match
    digest = None
    while True:
        edges = cut(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == digest:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b")).distinct()
        digest = now
