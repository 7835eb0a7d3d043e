"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import materialize

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the smallest node it is connected to.

    Alternates two steps until nothing changes: every node ties its larger neighbours to the smallest node around it, then its
    smaller neighbours. Each step keeps about as many pairs as it got; no node's neighbours are ever gathered. Pairs are
    stored after each round.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    pairs = materialize(edges.select(a.alias("a"), b.alias("b")).where("a < b").distinct(), "pairs")
    for _ in range(ROUNDS):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Larger neighbours of each node go to the smallest node around it.
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # Smaller neighbours of each node, and itself, go to the smallest of them.
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(small, "b")
        moved = joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(small.select(F.col("m").alias("a"), "b"))
        after = materialize(moved.distinct(), "pairs")
        size = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if size(after) == size(pairs):
            members = after.select(F.col("b").alias("node"), F.col("a").alias("root"))
            return members.union(after.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        pairs = after
    raise RuntimeError(f"not connected after {ROUNDS} rounds")
