"""Versions of stored data behind a pointer: readers never meet a half-written or half-deleted state.

A writer puts a new version into folders of its own and then publishes a small
record that names them. Publishing renames a finished file into ``_pointer``,
which HDFS and local file systems do atomically; record numbers grow, and the
highest is the current one. A failure before the rename leaves the former
record, and so the former version, in force. What no record names any more is
deleted after the next publication but one, so a reader that has just looked
up a record still finds its folders while one newer version is published.

There is one writer at a time (a batch job, or the driver of a stream).
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession

POINTER = "_pointer"


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders of ``path``, sorted; none if it does not exist."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f.getPath().toString() for f in fs.listStatus(p) if f.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has committed; a crash before that leaves no marker."""
    fs, p = filesystem(spark, os.path.join(path, "_SUCCESS"))
    return fs.exists(p)


def _records(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    fs, p = filesystem(spark, os.path.join(root, POINTER))
    if not fs.exists(p):
        return []
    found = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().endswith(".json")]
    return sorted((int(f.getName()[:-5]), f.toString()) for f in found)


def _load(spark: SparkSession, path: str) -> dict:
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, root: str, n: int = 1) -> list[dict]:
    """The ``n`` newest records of ``root``, newest first."""
    return [_load(spark, path) for _, path in reversed(_records(spark, root)[-n:])]


def publish(spark: SparkSession, root: str, record: dict) -> None:
    """Make ``record`` the current one; older records than the one before go."""
    have = _records(spark, root)
    number = have[-1][0] + 1 if have else 0
    fs, draft = filesystem(spark, os.path.join(root, POINTER, f".draft-{uuid.uuid4().hex}"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    _, final = filesystem(spark, os.path.join(root, POINTER, f"{number:020d}.json"))
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another writer has published record {number} of {root}")
    for _, old in have[:-1]:
        delete(spark, old)


def fresh(name: str) -> str:
    """A folder name that no earlier attempt has used."""
    return f"{name}-{uuid.uuid4().hex[:12]}"
