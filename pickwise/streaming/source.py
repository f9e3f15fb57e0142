"""Rating streams: any streaming DataFrame with a string ``value`` column.

Messages are ``user|product|score|epoch_seconds``. Production reads Kafka
(topic ``recommender``, latest offsets); tests read a folder of text files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise import schemas


def kafka_messages(spark: SparkSession, servers: str, topic: str = "recommender",
                   starting_offsets: str = "latest") -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the cluster)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("value").cast("string").alias("value")))


def text_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """value -> (user_id, product_id, score, time_stamp, valid); bad fields become null."""
    parts = F.split(F.col(value_col), re.escape(schemas.STREAM_FIELD_SEPARATOR))
    out = messages.select(
        F.trim(F.get(parts, 0)).try_cast("int").alias("user_id"),
        F.trim(F.get(parts, 1)).try_cast("int").alias("product_id"),
        F.trim(F.get(parts, 2)).try_cast("double").alias("score"),
        F.trim(F.get(parts, 3)).try_cast("bigint").alias("time_stamp"),
    )
    valid = (F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
             & F.col("score").isNotNull() & F.col("time_stamp").isNotNull())
    return out.withColumn("valid", valid)
