"""Connected components of an edge table by alternating large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import cut

MAX_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edge set, for the convergence test."""
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, root), root the smallest node reachable.

    Every round is a pre-aggregated minimum and one join on the node, so a node
    with very many links is combined before the shuffle and its join partition
    can be split at run time. Each round is cut with a reliable checkpoint. Only
    nodes that occur in ``edges`` are returned; self links are ignored; an empty
    table gives an empty result.
    """
    e = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
            .filter("a <> b").distinct())
    seen = _signature(e)
    if seen[0] == 0:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(MAX_ROUNDS):
        e = cut(_small_star(_large_star(e)))
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not converge")
    # a star: every node points at its root
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
