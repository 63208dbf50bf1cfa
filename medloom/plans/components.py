"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.session import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least id of its component, for every node of an edge.

    ``edges`` has two BIGINT columns ``a`` and ``b``; loops and repeats are
    harmless, null ends are dropped.  Each round is a minimum over neighbours
    with map-side combining, so a node with very many neighbours is never
    gathered in one task; the lineage is cut by a checkpoint each round.
    Nodes without an edge don't come out.
    """
    now = materialize(edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    for _ in range(max_rounds):
        star = _small_star(_large_star(now))
        after = materialize(star)
        # stars only: no node that is pointed to points elsewhere
        tall = after.select(F.col("b").alias("n")).join(after.select(F.col("a").alias("n")), "n", "left_semi").limit(1).count()
        now = after
        if not tall:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _with_least(pairs: DataFrame) -> DataFrame:
    """pairs (n, v) with m, the least of n and all its v."""
    least = pairs.groupBy("n").agg(F.least(F.min("v"), F.first("n")).alias("m"))
    return pairs.join(least, "n")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("n"), F.col("b").alias("v")).union(e.select(F.col("b").alias("n"), F.col("a").alias("v")))
    return _with_least(both).where("v > n").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("v"))
    linked = _with_least(down)
    out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(linked.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()
