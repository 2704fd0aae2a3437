"""Connected components of large graphs by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, written


def joined_split(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on one column so that adaptive execution can split a hot key.

    Null-safe equality makes Spark shuffle both sides for the join even where one
    is already dealt by the key, and only partitions of a shuffle for the join are split.
    """
    name = free_name(left.columns, "__key")
    right = right.withColumnRenamed(key, name)
    return left.join(right, left[key].eqNullSafe(right[name]), how).drop(name)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node it reaches.

    Each round hangs every node's larger neighbours, then its smaller ones, on its
    least neighbour and writes the new edges; a graph of stars repeats itself, which ends the loop.
    Rounds grow with the logarithm of the longest path.  Edges are pairs (a, b) of longs.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = written(edges.select(a.alias("a"), b.alias("b")).where("a != b").distinct(), "edges")
    state = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = joined_split(both, least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = joined_split(large, lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.a", "e.b").where("a != b").distinct(), "edges")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
