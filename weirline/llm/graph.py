"""Connected components of a large graph by alternating stars.

Each round links, around every node, its larger neighbours to the smallest node in
sight, then every node and its smaller neighbours to the smallest of them. Trees
shrink to stars in a number of rounds that grows with the logarithm of their size.
A hub's edges are grouped by a minimum that combines before the shuffle. The minima are
written before they meet the edges again: joined straight to the aggregate, the edges
would share its exchange, and Spark splits a hot key only where a join has exchanges of
its own. Nothing is gathered in one task, and only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import cut

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = cut(least.select("a", F.least("a", "m").alias("m")))
    linked = both.where("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger to the smaller node."""
    least = cut(edges.groupBy("a").agg(F.min("b").alias("m")))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.union(own).where("a > b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free sum over the edges, to see whether they changed."""
    folded = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), folded).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reached) for every node of ``edges``
    (``a, b``: any direction, loops and repeats allowed). Isolated nodes are missing."""
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = cut(ordered.distinct())
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        now = cut(_small_star(cut(_large_star(now))))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.distinct()
    )
