"""Connected components in written rounds (alternating large and small stars).

Every round is a few joins over the remaining edges; a long chain of n nodes
is done in O(log n) rounds. Each half round is written to the shared folder, so
the plan never grows and a lost executor costs one stage. A node's minimum is
written before it is joined, so both sides of that join are plain tables and a
node with very many edges can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.llm.common import pin


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes."""
    low = F.pmod(F.xxhash64("a", "b"), F.lit((1 << 40) - 87))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(low.cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pin(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star-least")
    out = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    return out.filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = pin(edges.groupBy("b").agg(F.min("a").alias("m")), "star-least")
    joined = edges.join(least, "b")
    moved = joined.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root: the smallest node
    of its component. ``edges`` is a pinned table with a < b; may be empty."""
    mark = _mark(edges)
    while mark[0]:
        edges = pin(_large_star(edges), "star-large")
        edges = pin(_small_star(edges), "star-small")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
