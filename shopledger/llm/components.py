"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm.tables import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    moved = both.join(least, "a").filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, moves to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long), root being the smallest node reachable.

    Each round stores its edges, which also cuts the lineage; the driver sees one count and one checksum a round.
    The number of rounds grows with the logarithm of the longest path. Grouping combines before it shuffles, and the
    joins can be split by adaptive skew handling, so a node with very many neighbours is no bottleneck.
    No edges: no rows.
    """
    edges = written(spark, edges.filter("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while mark != (mark := _mark(edges)):
        edges = written(spark, _small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
