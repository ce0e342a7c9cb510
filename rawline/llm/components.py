"""Connected components of a distributed edge list.

Alternating star contraction: each round links every node's larger (then
smaller) neighbours to the smallest one seen. A node's neighbours are never
gathered: the smallest is an aggregate with a map-side partial, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of u go to the smallest of u and its
    neighbours. Small star: u and its smaller neighbours do."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    around = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        out = around.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = around.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node that has an edge with the smallest node of its
    component. ``edges`` has (a, b), in any order."""
    edges = edges.filter("a <> b")
    seen = None
    while True:
        edges = settle(_star(_star(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
