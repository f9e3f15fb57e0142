"""Popularity and average-score statistics over a Rating table.

Each is a single hash aggregation with map-side partial aggregation, then a
global range-partitioned sort. Ties are ordered by product_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.columns import year_month


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """All-time popularity: (product_id, count), most rated first."""
    return (ratings.groupBy("product_id")
            .agg(F.count("product_id").alias("count"))
            .orderBy(F.desc("count"), F.asc("product_id")))


def rate_more_recently_products(ratings: DataFrame) -> DataFrame:
    """Monthly popularity: (year_month yyyyMM, product_id, count), newest month first."""
    return (ratings.select(year_month("time_stamp").alias("year_month"), "product_id")
            .groupBy("year_month", "product_id")
            .agg(F.count("product_id").alias("count"))
            .orderBy(F.desc("year_month"), F.desc("count"), F.asc("product_id")))


def average_products(ratings: DataFrame) -> DataFrame:
    """Average score per product: (product_id, avg), best first."""
    return (ratings.groupBy("product_id")
            .agg(F.avg("score").alias("avg"))
            .orderBy(F.desc("avg"), F.asc("product_id")))
