"""Intermediate tables in the shared checkpoint folder, and Arrow batch limits."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pickwise.session import apply_runtime_defaults, delete_on_exit, scratch_path


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: adaptive plans and small Arrow batches.

    Documents can be very long, so a batch handed to Python is bounded by bytes
    as well as by rows.
    """
    apply_runtime_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor later costs a read of shared files, and
    several branches of a plan share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like ``stored``, in ``buckets`` buckets by ``column``: a join on it moves only the other side, dealt likewise.

    The table is in the session's catalog only while it is written; its files stay.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = os.path.basename(path).replace("-", "_")
    (df.repartition(buckets, column).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, column).saveAsTable(table))
    delete_on_exit(spark, path)
    read = spark.table(table)
    spark.sql(f"drop table {table}")
    return read
