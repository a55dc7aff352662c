"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.plans.store import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b). Neighbour sets are never gathered: a minimum for each node,
    then a join, so a node with very many edges is split by the skew join."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(low, F.col("u") == F.col("w"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("w", "m"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (a, b) of any ordered type -> (node, root), root being the smallest node reachable.

    Nodes without an edge to another node are left out. Each round is written to the shared
    folder, so the plan stays short and a lost executor costs one round at most.
    """
    now = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        before, now = now, written(_star(_star(now, True), False), "edges")
        discard(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
