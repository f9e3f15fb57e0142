"""Session helper: AQE on, UTC pinned, checkpoint folder resolved from the session."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle-partition count and memory are left to
# the cluster: on a real cluster they come from spark-submit, in tests from the
# caller.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "pickwise", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings, applied also to a session someone else built."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.session.timeZone"):
        spark.conf.set(key, _DEFAULTS[key])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session (tests, bench) without the setting gets a fresh
    folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="pickwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint root for tables written mid-job."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove a written scratch path when the application ends (Hadoop deleteOnExit)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder; read it back.

    Used where one intermediate feeds several branches of a plan: each branch
    then scans the written copy (with column pruning) instead of recomputing
    the input, and the lineage is cut, so losing an executor later costs a
    re-read, not a recompute from the source tables. (A reliable
    ``checkpoint()`` of an unpersisted DataFrame would compute it twice.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    delete_on_exit(spark, path)  # scratch lives as long as the application
    return spark.read.parquet(path)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an execution leave the disks when it ends, not when its plan is collected as garbage.

    For jobs in steps that each write a table: the disks then hold the tables and the shuffles of
    one step. A plan that runs twice shuffles twice, as it does anyway unless the same object runs.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, in_bytes: int, expansion: float = 4.0,
                            target_bytes: int = 128 << 20) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so a shuffle partition holds ~target_bytes.

    Parquet input inflates several times once decoded into shuffle rows
    (``expansion``); AQE coalesces small partitions afterwards but cannot
    split large ones (except skewed join sides), so the count is set from
    the input size before planning and never lowered.
    """
    want = max(1, math.ceil(in_bytes * expansion / target_bytes))
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(current, want)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
