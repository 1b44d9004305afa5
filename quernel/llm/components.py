"""Connected components over an edge table by alternating large-star and small-star steps, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import drop_stash, stash


def _pairs(df: DataFrame) -> DataFrame:
    return df.where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return _pairs(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return _pairs(linked.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b"))


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b: long) -> (node, root): root is the least node of node's component; nodes without an edge are absent.

    Each round is stashed in the shared folder, so a lost executor costs one round at most. Rounds grow with the logarithm of
    a component's size; an edge table that doesn't settle raises."""
    state, mark = None, None
    current = stash(_pairs(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    for _ in range(most_rounds):
        n, h = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, h) == mark or not n:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
        mark, state = (n, h), current
        current = stash(_small_star(_large_star(state)), "edges")
        drop_stash(state)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
