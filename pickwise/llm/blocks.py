"""Comparing the members of a group in blocks of bounded size.

A group of n members is hashed into ceil(n / rows) blocks; each member is sent
to every pair of blocks that includes its own. A pair of blocks is one unit of
work: sorted rows with equal (key, i, j), which a task reads one unit at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, key: str, n: str, rows: int, columns: list[str]) -> DataFrame:
    """Members of groups ``key`` of ``n`` rows -> sorted rows (key, i, j, id, block, *columns)."""
    blocks = F.ceil(F.col(n) / rows).cast("long")
    return (members.withColumn("block", F.pmod(F.xxhash64("id"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select(F.col(key).alias("key"), F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j"), "id", "block", *columns)
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))


def units(batches):
    """The units of ``block_pairs``, each as one table."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in (0, 1, 2)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            if held and tuple(keys[start]) != key:
                yield pa.Table.from_batches(held)
                held = []
            key = tuple(keys[start])
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def sides(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a unit, and whether they are the same block."""
    first = blocks == blocks.min()
    a = np.flatnonzero(first)
    return (a, a, True) if first.all() else (a, np.flatnonzero(~first), False)
