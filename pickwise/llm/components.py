"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a join and an aggregation over the edge table; nothing is
collected but two numbers per round, which tell whether the edges changed. The
edges of a round are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, moves to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.union(least.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long ids -> (node, component): the smallest node reachable, for nodes with edges."""
    def mark(df: DataFrame):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = stored(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
                 .filter(F.col("u") != F.col("v")).distinct(), "edges")
    before = mark(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
