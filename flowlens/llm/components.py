"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import stage


def _largest_to_least(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct())


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them; edges point downwards here."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component``: every node with an edge, and the least node it is connected to.

    ``edges`` has columns ``a`` and ``b``; direction, order and repetition do not matter, a row with
    a null or with a = b joins nothing. Minima are combined before the shuffle, so a node with very
    many neighbours costs one row per task; the joins on it are split by Spark's skew handling. Each
    round is written to the shared scratch folder; rounds end when a round changes nothing.
    """
    current = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    seen = None
    while True:
        current = stage(_smaller_to_least(_largest_to_least(current)), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    return (current.groupBy("a").agg(F.min("b").alias("component"))
            .select(F.col("a").alias("node"), "component")
            .union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
