"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``edges`` (a, b) but the smallest ones.

    Each round links every node to its smallest neighbour (large star) and then the neighbours below a
    node to the smallest of them (small star). Minima are combined before the shuffle; the joins back
    are on plain keys, so a hub is split by the skew join. Rounds grow with the logarithm of the size.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        lower = edges.join(least, "a")
        moved = lower.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


__all__ = ["components"]
