"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.columns import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours and itself to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    sent = down.join(least, "a").where(F.col("b") != F.col("least")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    return sent.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Every node has one edge to a smaller one at most, and none that others point to has any."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b) but the roots, the least node of each component.

    Edges from a node to itself and nulls are left aside; without edges there are no rows. The number
    of rounds grows with the logarithm of a component's size; edges that are stars already take none. Each
    round is kept in the checkpoint folder, and only one flag of it comes to the driver.
    """
    down = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = settle(down.distinct())
    while not _all_stars(now):
        now = settle(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
