"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by their
membership pattern (the set of their sources); only the patterns, not the
documents, take part in the flow: tokens go from each pattern to the sources it
belongs to, up to a quota per source. Using a pattern's tokens once is free and
every further repetition costs one more than the last (a convex cost), so the
flow repeats nothing while unused tokens can do. Each pattern's routed tokens
are then taken from its documents in a seeded random order.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null
source is a source of its own, ordered last; a document without any source is
taken 0 words; rows with equal ids are documents of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.llm.storage import stored

WORD = "[^\\x20\\x09-\\x0D]+"
BUCKET_ROWS = 4096  # documents in one step of the seeded order


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-blank characters; 0 for null."""
    starts = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.char_length(F.regexp_replace(starts, "[^x]+", "")), F.lit(0)).cast("long")


def source_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (3, 1, 2),
                   total_share: float = 1.5, max_repeats: int = 2) -> dict[str | None, float]:
    """Quota per source: ``total_share`` of all sizes by weight, at most ``max_repeats`` times a size.

    Sources are ordered by code point, null last, and take the weights in turn;
    what a capped source leaves is shared again by weight until none is above.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, targets, left = list(names), {}, total_share * sum(sizes.values())
    while open_:
        per_weight = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if per_weight * weight[s] > max_repeats * sizes[s]]
        if not above:
            targets.update({s: per_weight * weight[s] for s in open_})
            break
        for s in above:
            targets[s] = float(max_repeats * sizes[s])
            left -= targets[s]
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(patterns: list[tuple[tuple, int]], quotas: dict, max_repeats: int = 2) -> dict[tuple[int, object], int]:
    """Min-cost flow: (pattern index, source) -> tokens.

    ``patterns`` holds (sources, tokens). Costs lie on the arcs into the
    patterns only and grow by one with each repetition, so the cheapest paths
    are exhausted level by level: each level opens another ``tokens`` of every
    pattern and augments along shortest residual paths.
    """
    flow: dict[tuple[int, object], int] = defaultdict(int)
    feeders: dict[object, list[int]] = defaultdict(list)
    for p, (sources, _) in enumerate(patterns):
        for s in sources:
            feeders[s].append(p)
    room = dict(quotas)
    used = [0] * len(patterns)
    for level in range(1, max_repeats + 1):
        while True:
            # breadth-first search from every pattern with capacity on this level
            came: dict[tuple[str, object], tuple[str, object] | None] = {}
            queue = deque()
            for p, (sources, tokens) in enumerate(patterns):
                if used[p] < level * tokens and sources:
                    came["p", p] = None
                    queue.append(("p", p))
            end = None
            while queue and end is None:
                kind, x = node = queue.popleft()
                if kind == "p":
                    for s in patterns[x][0]:
                        if ("s", s) not in came:
                            came["s", s] = node
                            if room.get(s, 0) > 0:
                                end = ("s", s)
                                break
                            queue.append(("s", s))
                else:
                    for p in feeders[x]:
                        if flow[p, x] > 0 and ("p", p) not in came:
                            came["p", p] = node
                            queue.append(("p", p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            first = path[-1][1]
            amount = min(room[end[1]], level * patterns[first][1] - used[first])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":  # reached back over a used arc from source b
                    amount = min(amount, flow[a[1], b[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "s":
                    flow[b[1], a[1]] += amount
                else:
                    flow[a[1], b[1]] -= amount
            used[first] += amount
            room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def mix_sources(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text",
                weights: tuple[float, ...] = (3, 1, 2), total_share: float = 1.5,
                max_repeats: int = 2, seed: int = 17) -> DataFrame:
    """(id, sources, size, source_size, target, taken) per document.

    ``sources`` is an array column of the sources a document belongs to.
    ``source_size`` and ``target`` are those of the first of them. The driver
    holds one row per distinct membership pattern.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(F.col(id_col).alias("id"),
                    F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))).alias("sources"),
                    word_count(F.col(text_col)).alias("size"))
        .withColumn("pattern", F.to_json("sources")), "mix-sizes")
    rows = sized.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    members = [tuple(json.loads(r["pattern"])) for r in rows]
    sizes: dict[str | None, int] = defaultdict(int)
    for m, r in zip(members, rows):
        for s in m:
            sizes[s] += r["size"]
    targets = source_targets(sizes, weights, total_share, max_repeats)
    flow = route([(m, r["size"]) for m, r in zip(members, rows)],
                 {s: round(t) for s, t in targets.items()}, max_repeats)
    routed: dict[int, int] = defaultdict(int)
    for (p, _), tokens in flow.items():
        routed[p] += tokens
    plan = spark.createDataFrame(pa.table({
        "pattern": pa.array([r["pattern"] for r in rows], pa.string()),
        "buckets": pa.array([-(-r["n"] // BUCKET_ROWS) for r in rows], pa.int64()),
        "copies": pa.array([routed[p] // r["size"] if r["size"] else 0 for p, r in enumerate(rows)], pa.int64()),
        "rest": pa.array([routed[p] % r["size"] if r["size"] else 0 for p, r in enumerate(rows)], pa.int64()),
        "source_size": pa.array([sizes[m[0]] if m else None for m in members], pa.int64()),
        "target": pa.array([targets[m[0]] if m else None for m in members], pa.float64()),
    }))
    order = F.xxhash64("id", F.lit(seed))
    placed = (sized.join(plan, "pattern")
              .withColumn("order", order)
              .withColumn("bucket", F.pmod("order", F.col("buckets"))))
    # buckets are taken in order until the rest of the pattern's tokens falls inside one
    sums = placed.groupBy("pattern", "bucket", "rest").agg(F.sum("size").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("pattern").orderBy("bucket")
                                             .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = stored(sums.withColumn("before", before)
                  .filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("tokens")))
                  .select("pattern", F.col("bucket").alias("edge"), (F.col("rest") - F.col("before")).alias("gap")),
                  "mix-edges")
    marked = placed.join(edge, "pattern", "left")
    out_cols = ["id", "sources", "size", "source_size", "target", "taken"]
    base = F.col("copies") * F.col("size")
    inner = (marked.filter(~F.col("bucket").eqNullSafe(F.col("edge")))
             .withColumn("taken", base + F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)))
    fill = (marked.filter(F.col("bucket") == F.col("edge"))
            .groupBy("pattern").applyInPandas(_fill_gap, T.StructType([*marked.schema, T.StructField("taken", T.LongType())])))
    return inner.select(out_cols).union(fill.select(out_cols)).withColumnRenamed("id", id_col)


def _fill_gap(rows):
    """One bucket in seeded order: take documents that fit the gap; a last one if that comes nearer."""
    rows = rows.sort_values(["order", "size"], kind="stable")
    size, gap = rows["size"].to_numpy(), int(rows["gap"].iloc[0])
    taken = (rows["copies"].to_numpy() * size).copy()
    left_out = []
    for i, n in enumerate(size):
        if n <= gap:
            taken[i] += n
            gap -= n
        else:
            left_out.append(i)
    if left_out:
        i = min(left_out, key=lambda k: size[k])
        if size[i] < 2 * gap:
            taken[i] += size[i]
    rows["taken"] = taken
    return rows
