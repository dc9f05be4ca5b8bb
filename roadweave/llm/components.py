"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.sources.tables import materialize


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node around."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) for every node that isn't the smallest of its component.

    ``links``: a, b (longs, in any order, repeats and loops allowed). Every round is written to the shared folder; only a
    count and a checksum come to the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = materialize(edges), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not state[0] or tuple(state) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark = tuple(state)
        edges = materialize(_small(_large(edges)))
