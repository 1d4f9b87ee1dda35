"""Connected components by alternating large and small stars.

Each round joins every node's smallest neighbour to its edges: first to larger
neighbours, then to smaller ones.  Both keep all components and pull them towards
stars around their smallest node; the number of rounds grows with the logarithm
of the longest path.  Edges stay in Spark; only their count and sum come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of `edges` (a, b bigint); root is the smallest node that it reaches."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_of = None
    for _ in range(rounds):
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours move to the smallest of them.
        large = stored(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        now = stored(small.where("a <> b").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == print_of:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        print_of = tuple(seen)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
