"""Connected components of a graph of integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]
    return row["n"], row["x"]


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``. Written, so that the join with it can split a node of many edges."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``edges`` (a, b) but the roots.

    Large and small stars by turns: each node's neighbours are tied to the smallest of them, first the larger ones,
    then the smaller ones, until nothing moves. The rounds grow with the logarithm of the longest chain; a node of any
    degree is handled in parts. An edge from a node to itself, or with a null, counts for nothing.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        tied = large.join(_least(large), "u")
        small = tied.select(F.col("u"), F.col("m").alias("v")).unionByName(
            tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = written(small.distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
