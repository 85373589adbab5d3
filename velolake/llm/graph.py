"""Connected components by alternating large-star and small-star rounds, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.session import scratch_scope, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    # Stored, so that the join sees two plain shuffles and can split a hot node.
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.filter("v > u").join(least.hint("shuffle_hash"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, goes to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least.hint("shuffle_hash"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that it reaches) of every node with an edge to another.

    `edges` has two columns of one ordered type without nulls; direction and repeats do not
    matter. Each round is stored, and rounds end when the stars no longer change: after about the
    logarithm of the longest shortest path.
    """
    u, v = edges.columns
    with scratch_scope(edges.sparkSession) as keep:
        edges = stored(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v").distinct(), "edges")
        state = None
        while True:
            with scratch_scope(edges.sparkSession) as needed:
                edges = needed(stored(_small_star(stored(_large_star(edges), "large-stars")).distinct(), "stars"))
            now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            if now == state:
                break
            state = now
        roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        return keep(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
