"""Per-group top-k and nesting of long-form recommendations into ``recs`` arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per group under ``order``; adds a 1-based rank.

    ``row_number() <= k`` is planned as a window group limit, so each task keeps
    only k rows per group before and after the shuffle.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def to_recs(long_df: DataFrame, key: str, item: str = "rec_product_id", score: str = "score",
            rank_col: str | None = "rank") -> DataFrame:
    """(key, item, score[, rank]) -> (key, recs array<struct<product_id, score>>), best first.

    Only for bounded lists (top-k outputs): the whole list of a key is built in
    one row. Order is by rank when given, else by score desc then item id.
    """
    if rank_col:
        sort_key = F.struct(F.col(rank_col).alias("k1"), F.col(item).alias("k2"))
    else:
        sort_key = F.struct((-F.col(score)).alias("k1"), F.col(item).alias("k2"))
    entry = F.struct(sort_key.alias("o"),
                     F.struct(F.col(item).alias("product_id"), F.col(score).alias("score")).alias("r"))
    recs = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["r"])
    return long_df.groupBy(key).agg(recs.alias("recs"))


def from_recs(nested: DataFrame, key: str) -> DataFrame:
    """(key, recs) -> long form (key, rec_product_id, score, rank)."""
    return nested.select(key, F.posexplode("recs").alias("pos", "r")).select(
        key,
        F.col("r.product_id").alias("rec_product_id"),
        F.col("r.score").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def to_rec_chunks(long_df: DataFrame, key: str, size: int, item: str = "rec_product_id",
                  score: str = "score") -> DataFrame:
    """(key, item, score) -> (key, part, recs): uncapped lists, best first, in numbered chunks of ``size``.

    Every row holds at most ``size`` entries, however long a list is: chunk 0 has
    the best, the last chunk the rest.
    """
    order = Window.partitionBy(key).orderBy(F.round(score, 9).desc(), F.asc(item))
    placed = long_df.select(key, item, score, (F.row_number().over(order) - 1).alias("place")).withColumn(
        "part", F.expr(f"place div {int(size)}").cast("int"))
    entry = F.struct("place", F.struct(F.col(item).alias("product_id"), F.col(score).alias("score")).alias("r"))
    return placed.groupBy(key, "part").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["r"]).alias("recs"))
