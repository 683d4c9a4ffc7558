"""Connected components of an edge table by alternating large-star and
small-star steps.  Every step is a pre-aggregated minimum per node and a join;
edges are rewritten to the shared folder after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(directed: DataFrame) -> DataFrame:
    """directed: (u, v) from a node to its neighbours; (v, smallest of u and its neighbours)."""
    low = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(low, "u")


def connected(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, component): component is the smallest node that
    can be reached.  Nodes without edges do not appear; a loop (a = b) is a node."""
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large)
        e = stored(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    root = e.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes.node == root.u, "left").select("node", F.coalesce("component", "node").alias("component"))
