"""Product and rating tables derived from the driver's test tables.

* ``ratings_orders``: a line item is a rating of part ``l_partkey`` by the
  ordering customer; score ``1 + l_quantity % 5``; time = order date.
* ``ratings_events``: an event is a rating of product ``props.k`` by
  ``user_id``; score ``least(5, 1 + floor(value / 20))``; time = ``ts``.
* ``products_from_part``: name ``p_name``, categories ``p_type``, tags the
  words of ``p_name`` plus ``p_brand`` and ``p_type``, joined by ``|``.
* ``item_vectors``: ``embeddings`` as (item_id, vector<double>).

Ids are cast to int with ANSI casts, so an id out of int range fails loudly.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.functions.columns import epoch_seconds


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ratings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        (F.lit(1.0) + F.col("l_quantity") % 5).cast("double").alias("score"),
        epoch_seconds("o_orderdate").alias("time_stamp"),
    )


def ratings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_table(spark, sf_dir, "events").select("user_id", "props", "value", "ts")
    return ev.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("product_id"),
        F.least(F.lit(5.0), F.lit(1.0) + F.floor(F.col("value") / 20)).cast("double").alias("score"),
        epoch_seconds("ts").alias("time_stamp"),
    )


def products_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    tags = F.concat_ws("|", F.regexp_replace("p_name", " ", "|"), F.col("p_brand"), F.col("p_type"))
    return p.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit("").alias("image_url"),
        F.col("p_type").alias("categories"),
        tags.alias("tags"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").cast("int").alias("item_id"),
                    F.col("embedding").cast("array<double>").alias("vector"))
