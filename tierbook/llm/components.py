"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop_scratch, materialise


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step: hang each node's larger (or smaller and own) neighbours on the least node around it."""
    if large:
        around = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = around.join(least, "a")
    if large:
        moved = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node it reaches.

    Alternating large-star and small-star steps; each aggregates before it
    shuffles, and each result is written to the shared folder. The number of
    rounds grows with the logarithm of the longest chain.
    """
    pairs = materialise(edges.where("a != b").select("a", "b").distinct(), "edges")
    before = None
    while (now := _digest(pairs)) != before:
        before = now
        last, pairs = pairs, materialise(_star(_star(pairs, True), False), "stars")
        drop_scratch(last)
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
