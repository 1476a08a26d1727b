"""Connected components of a graph that is never in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number and order-independent hash of the edges, to see whether a round changed any."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
    return row["n"], row["h"] or 0


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b``: the smallest node that it is connected with.

    Edges with a null end, loops and repeated edges count for nothing.

    Alternates large-star and small-star steps, each of which hangs nodes onto the smallest
    neighbour; rounds grow with the logarithm of the longest path, not with its length.  Minima
    are combined before the shuffle, and joins are on the smaller table's unique key, which lets
    the skewed side of a star be split.  Each round is written to the shared folder.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v")).distinct()
    e = write_table(e)
    before = _mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours are hung onto the smallest one.  All edges end up (larger, smaller).
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: so are the smaller neighbours, and the node itself.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = write_table(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _mark(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
