"""Connected components of a link table, by alternating star contraction.

Each round hangs every node's larger neighbours, then its smaller ones, below its smallest
neighbour, until all components are stars. Rounds grow with the logarithm of the longest
chain. Every round is two aggregates and two joins on node ids, staged in the shared folder.
A node with very many links is the large side of the join, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sinks.staging import stage


def _hang_larger(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _hang_smaller(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for each node with a link: the smallest node that links lead to.

    `links` is (a, b) in either order, repeats and self-links allowed; rows with a NULL link
    nothing. An empty table gives an empty table.
    """
    signs = {"state": F.bit_xor(F.xxhash64("a", "b"))}
    first, second = links.columns
    ordered = links.select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
    ).filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    stars, seen = stage(spark, ordered.distinct(), "links", **signs)
    while True:
        before = seen
        stars, seen = stage(spark, _hang_smaller(_hang_larger(stars)), "stars", **signs)
        if seen == before:
            break
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
