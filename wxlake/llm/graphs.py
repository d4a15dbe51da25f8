"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of every node of the edges ``a``, ``b``.

    Loops and repeated edges don't matter. Rounds of large and small stars: every node sends its
    larger, then its other neighbours to the smallest one, until each hangs on its root. Minima are
    combined before the shuffle, and joins on a node split where it has many edges.
    Each round is written, so the lineage stays short.
    """
    edges = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        # Large star: neighbours above a node go to the smallest of its neighbours and itself.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b"), "large-stars")
        # Small star: neighbours below a node, and itself, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        moved = large.join(least, F.col("a") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = materialise(moved.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and 128 bits of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))).first())
