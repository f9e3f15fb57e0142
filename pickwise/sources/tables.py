"""Named tables: overwrite on write, typed on read. Parquet under a base folder.

A table is a folder of versions (:mod:`pickwise.sources.versions`). An
overwrite writes a new version and then switches to it, so the former table
stays readable until then, also for the query that is overwriting it, and
survives a write that fails. A plain parquet folder is read as it is.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.sources import versions


def table_path(base: str, name: str) -> str:
    return os.path.join(base, name)


def current_path(spark: SparkSession, base: str, name: str) -> str:
    """The folder that holds the table's current version."""
    root = table_path(base, name)
    record = versions.newest(spark, root)
    return os.path.join(root, record[0]["folder"]) if record else root


def write_table(df: DataFrame, base: str, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a named table and return its folder; ``append`` adds to the current version.

    Other modes (``ignore``, ``error``) do nothing or fail where the table exists.
    """
    spark, root = df.sparkSession, table_path(base, name)
    exists = bool(versions.newest(spark, root))
    if exists and mode == "ignore":
        return root
    if exists and mode in ("error", "errorifexists"):
        raise ValueError(f"table {name} exists already")
    adding = exists and mode == "append"
    folder = versions.newest(spark, root)[0]["folder"] if adding else versions.fresh("v")
    writer = df.write.mode("append" if adding else "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(os.path.join(root, folder))
    if not adding:
        versions.publish(spark, root, {"folder": folder})
        kept = {record["folder"] for record in versions.newest(spark, root, 2)} | {versions.POINTER}
        for old in versions.folders(spark, root):
            if os.path.basename(old) not in kept:  # a version before the last, or a failed attempt
                versions.delete(spark, old)
    return root


def read_table(spark: SparkSession, base: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Load a named table; with ``schema``, select exactly its fields with its types."""
    df = spark.read.parquet(current_path(spark, base, name))
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {name} lacks columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
