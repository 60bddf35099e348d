"""Connected components of an edge table by alternating star contraction, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.llm.stored import stored


def _stars(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    moved = both.join(least, "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("least")))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. ``a`` is larger than ``b`` on every row."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("least"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        least.select("a", F.col("least").alias("b"))
    )


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has an edge to another, ``component`` its smallest reachable node.

    Repeated edges, loops and NULL ends are fine and add nothing. An edge table without rows gives none. Each round is
    written to the shared folder, so a lost executor costs one round at most; rounds grow with the logarithm of the
    largest component, and only two numbers a round reach the driver.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") > F.col("b")).distinct()
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        large = _stars(now).distinct()
        now = stored(_small_stars(large).distinct())
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
