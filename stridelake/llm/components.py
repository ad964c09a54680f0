"""Connected components of an edge table, by alternating large-star and
small-star steps. Each step is a join with a per-node minimum that is written
first, so a node with very many edges is split over tasks as any skewed join
is. No edge, link or component goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b. Large star: each node's larger neighbours go
    to its least neighbour (itself included). Small star: its smaller ones."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star")
        out = (both.where(F.col("b") > F.col("a")).join(low, "a")
               .select(F.col("b").alias("a"), F.col("m").alias("b")))
    else:
        low = cut(edges.groupBy("a").agg(F.min("b").alias("m")), "star")
        out = (edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(low.select("a", F.col("m").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the component's least
    node. ``edges`` has columns a and b of one ordered type."""
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .where(F.col("a") != F.col("b")).distinct(), "edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        now = cut(_star(cut(_star(now, True), "large"), False), "small")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
    else:
        raise RuntimeError("components didn't settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
