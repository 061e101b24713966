"""Connected components of a graph given as edges, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.shared import store


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("h")).first()
    return row.n, row.h


def _downward(a: DataFrame) -> DataFrame:
    """Edges (a, b) as (hi, lo), each once, without loops."""
    return a.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with an edge to another one; root is the smallest node it reaches.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats, loops and nulls mean nothing.
    Each round sends every larger neighbour of a node to the smallest one (large star), then every smaller
    neighbour (small star). Edges shrink to one star per component, after a number of rounds that grows with
    the logarithm of the longest path. Every state is written to the shared folder, and so are the smallest
    neighbours: both sides of each join are then plain shuffles, so that a hub's edges can be split.
    """
    state = store(_downward(edges.select("a", "b").na.drop()), "edges")
    before = _state(state)
    while before[0]:
        both = state.select(F.col("hi").alias("a"), F.col("lo").alias("b")).union(state.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = state.select(F.col("lo").alias("a"), F.col("hi").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = store(_downward(large), "large")

        least = store(state.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        joined = state.join(least, "hi")
        small = joined.select(F.col("lo").alias("a"), F.col("m").alias("b")).union(least.select(F.col("hi").alias("a"), F.col("m").alias("b")))
        state = store(_downward(small), "small")
        after = _state(state)
        if after == before:
            break
        before = after
    roots = state.select("lo").distinct()
    return state.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select(F.col("lo").alias("node"), F.col("lo").alias("root")))
