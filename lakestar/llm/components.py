"""Connected components by alternating large and small stars.

Each round hangs the neighbours of every node on the smallest of them. Rounds are stored tables of
two columns; only their number of rows and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of any direction to (node, root): the smallest node of the component, for every node
    but the roots themselves."""
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)).filter("a <> b").distinct(), "stars")
        state = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
