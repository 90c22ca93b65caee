"""Connected components of tables of links, by joins alone.

``roots`` follows links that all lead upwards, one from each node: the pointers of
a forest are doubled, so the rounds grow with the logarithm of its height.
``components`` takes any links, by alternating large and small stars: each round is
two joins on an aggregated minimum, and the rounds grow with the logarithm of the
longest chain.  No neighbour list is ever collected, so a node of any degree costs
its task no memory, whatever the number of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.llm.session import cut, join_with_hot


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node v of ``links`` (u, v) and every root: nodes without a link of their own.

    Each v has one row at most, and the links have no cycles.  No links give no rows.
    """
    up = links.select(F.col("v").alias("node"), F.col("u").alias("root"))
    while True:
        # A root that many nodes have reached is one row here, and its nodes are dealt over shares below.
        reached = up.groupBy("root").agg(F.count("*").alias("m")).join(up.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
        reached = cut(reached)
        if reached.where("next IS NOT NULL").isEmpty():
            return up.union(reached.select(F.col("root").alias("node"), "root"))
        up = cut(join_with_hot(up, reached, ["root"], "m").select("node", F.coalesce("next", "root").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge; component is the smallest node reachable.

    ``edges`` has long columns u and v in any direction; loops, repeats and nulls
    are ignored, and no edges give no rows.
    """
    now = cut(edges.select("u", "v").where("u != v").distinct())
    seen = _digest(now)
    while seen[0]:
        now = cut(_small_star(_large_star(now)))
        after = _digest(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
