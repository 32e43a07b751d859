"""Distributed connected components by alternating stars.

Each round links every node to the smallest node it can see, first among
its larger neighbours (large star), then among its smaller ones (small
star).  The rounds end when all components are stars around their smallest
node; their number grows with the logarithm of the longest path.  Minima
are aggregates with map-side combine and are joined back on the node, so a
hub that holds a third of all edges is split by the skew join.  Each round
is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge; component is its
    smallest reachable node.  Null ends and self-loops link nothing."""
    a, b = F.col(left), F.col(right)
    e = stage(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "cc")
    before, now = None, _state(e)
    while now[0] and now != before:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
                     .union(low.select("a", F.col("m").alias("b"))).distinct()
        e = stage(small, "cc")
        before, now = now, _state(e)
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")) \
            .union(roots.select("node", F.col("node").alias("component")))
