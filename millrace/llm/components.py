"""Connected components by large-star and small-star rounds over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) tied to its least neighbour."""
    if large:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        tied = around.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        tied = down.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).union(least.select("a", "m"))
    return tied.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) of every node that has an edge (columns `a`, `b`); the root is the least node of its component.

    Groups are never gathered: each round takes one minimum per node and joins it back.  Rounds grow with the logarithm
    of the longest chain; each is written as a table.
    """
    edges = cut_lineage(edges.select("a", "b").where("a != b").distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = cut_lineage(_star(_star(edges, True), False))
    roots = edges.select(F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("root", "root"))
