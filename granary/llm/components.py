"""Connected components of a graph given as a table of edges.

Alternating stars: every node's neighbours are hung on the smallest of them,
first the larger neighbours, then the smaller ones, until nothing changes.  The
number of rounds grows with the logarithm of the longest path.  Each round
aggregates with partial minima and joins on a node; the minima are broadcast
while they are few, and else Spark splits the join of a node with a large share
of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.storage import cut, drop, read_back, written

#: Up to so many edges the nodes' minima (two longs, two for each edge at most) are broadcast, beyond it they are shuffled.
BROADCAST_EDGES = 500_000


def _stars(edges: DataFrame, few: bool) -> DataFrame:
    """One large and one small star over edges ``a > b``."""

    def side(minima: DataFrame, name: str) -> DataFrame:
        # written first if many, so that both sides of the join are dealt just for it and Spark can split a hot node
        return F.broadcast(minima) if few else cut(minima, name)

    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("low"))
    # larger neighbours hang on the least of the neighbourhood
    large = edges.join(side(least, "least"), F.col("b") == F.col("u")).select("a", F.col("low").alias("b")).distinct()
    down = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), "low")
    small = large.join(side(down, "down"), F.col("a") == F.col("u")).select("a", "b", "low")
    return (
        small.select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(small.select("a", F.col("low").alias("b")))
        .filter("a > b")
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node with an edge.

    ``edges`` has two columns of longs, either way round and repeated as may be;
    loops are ignored, nulls too.  No edges give no rows.
    """
    spark = edges.sparkSession
    a, b = edges.columns[:2]
    path = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first())

    now = state(read_back(spark, path))
    for _ in range(rounds):
        if not now[0]:
            break
        after = written(_stars(read_back(spark, path), now[0] <= BROADCAST_EDGES), "edges")
        drop(spark, path)
        path, before = after, now
        now = state(read_back(spark, path))
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = read_back(spark, path)
    return found.select(F.col("a").alias("node"), F.col("b").alias("root")).union(found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
