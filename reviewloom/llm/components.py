"""Connected components of a large graph by alternating star steps; every step is a shuffle or two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour (or itself)."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    met = ways.where("b > a").join(least, "a")
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    met = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return met.unionAll(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that it reaches.

    Each step leaves stars of shrinking depth; it is over when every node points at a node that points
    nowhere. The number of steps grows with the logarithm of the longest path. Only one count per step comes
    to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    while True:
        # Edges point from the larger node to the smaller one.
        edges = stored(_small_star(_large_star(edges)), "stars")
        pointed = edges.select("b").distinct().withColumnRenamed("b", "_b")
        middle = edges.join(pointed, F.col("a") == F.col("_b"), "left_semi")
        twice = edges.groupBy("a").count().where("count > 1").select("a")
        if middle.select("a").unionAll(twice).isEmpty():
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
