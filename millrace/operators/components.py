"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import discard, written

#: A graph of n nodes settles within O(log n) rounds in practice; this many means that something is wrong.
MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node it is linked with) for every node of edges (a, b); null ends and loops are dropped.

    Each round replaces edges by stars round the smallest neighbour, so hubs shrink instead of being collected;
    every step is a grouped minimum and an equi-join. Rounds are written to the shared folder, which cuts the
    lineage; only two numbers per round reach the driver. An empty table gives no rows.
    """
    now = written(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    seen = None
    for _ in range(MAX_ROUNDS):
        near = _both_ways(now)
        # large star: every neighbour above the node goes to the smallest of node and neighbours
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every neighbour below the node, and the node, go to the smallest of them
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, now = now, written(moved.union(below.select("a", F.col("m").alias("b"))).distinct(), "components")
        discard(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    found = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = now.select(F.col("b").alias("node")).distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.union(roots)
