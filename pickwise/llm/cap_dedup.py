"""Embedding near-dedup by spherical-cap filters (Becker, Ducas, Gama, Laarhoven, SODA 2016).

Filter directions form a random product code: a vector, rotated at random, is
cut in two halves, each half has ``CODE_WORDS`` random directions, and every
pair of them is one of 4096^2 filters. A vector is list-decoded to all filters
whose cosine with it exceeds a cap height, without scanning the pairs that
cannot. ``CODES`` codes with rotations of their own make a miss at cosine 0.93
rarer than 1 in 1000. Vectors that share a label and a filter are candidates;
cosines are always checked in double precision on the vectors themselves.

1. every member of a filter bucket is compared with the bucket's smallest id;
   the confirmed links are joined into components;
2. members of one bucket that lie in different components are compared with
   each other in blocks, and the components are joined again;
3. links are counted within each component, block by block, every pair once.

No pairs are spelled out: steps 2 and 3 return a row per vector and block.
Equal vectors form a class that goes on once; its size counts in the links.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components, and one with a null label, links with nothing and is kept; vectors
of different lengths are not compared; equal rows are vectors of their own (and
link with each other); if one id holds several vectors, their links are pooled;
a null id keeps its row without links; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.blocks import block_pairs, sides, units
from pickwise.llm.components import connected_components
from pickwise.llm.storage import stored

CODES, CODE_WORDS, CAP = 6, 4096, 4.4  # cap height in standard deviations of a random cosine
LEAST_DIM = 64  # shorter vectors are padded: angles, and so the odds of a hit, stay the same
BLOCK_ROWS = 1024

DECODED = "id long, label string, n_dim int, ok boolean, digest binary, vec binary, filters array<long>"


def _code(dim: int, number: int):
    """(rotation, codewords of the first half, of the second half) of one code, from its number."""
    rng = np.random.default_rng([97, dim, number])
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    halves = []
    for width in (dim // 2, dim - dim // 2):
        words = rng.standard_normal((CODE_WORDS, width))
        halves.append(words / (np.linalg.norm(words, axis=1, keepdims=True) * np.sqrt(2)))
    return rotation, *halves


def list_decode(vectors: np.ndarray, codes: list) -> list[list[int]]:
    """All filters whose cosine with each vector exceeds the cap height."""
    dim = max(LEAST_DIM, vectors.shape[1])
    units_ = np.zeros((len(vectors), dim))
    units_[:, :vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out: list[list[int]] = [[] for _ in vectors]
    height = CAP / np.sqrt(dim)
    for number, (rotation, left, right) in enumerate(codes):
        turned = units_ @ rotation
        a, b = turned[:, :left.shape[1]] @ left.T, turned[:, left.shape[1]:] @ right.T
        a_best, b_best = a.max(axis=1), b.max(axis=1)
        for i in range(len(vectors)):
            p = np.flatnonzero(a[i] >= height - b_best[i])
            q = np.flatnonzero(b[i] >= height - a_best[i])
            x, y = np.nonzero(a[i][p][:, None] + b[i][q][None, :] >= height)
            out[i] += ((number * CODE_WORDS + p[x]) * CODE_WORDS + q[y]).tolist()
    return out


def _decode(batches):
    codes: dict[int, list] = {}
    for batch in batches:
        n = batch.num_rows
        rows: list[np.ndarray | None] = []
        for v in batch.column(1).to_pylist():
            x = None if not v or None in v else np.array(v, np.float64)
            if x is not None:  # scaled first, so that neither tiny nor huge components lose the norm
                top = np.abs(x).max()
                x = x / top if np.isfinite(x).all() and top > 0 else None
            rows.append(x)
        labelled = batch.column(2).is_valid().to_pylist()
        good = [x is not None and has for x, has in zip(rows, labelled)]
        filters: list = [None] * n
        for dim in {len(rows[i]) for i in range(n) if good[i]}:
            at = [i for i in range(n) if good[i] and len(rows[i]) == dim]
            wide = max(LEAST_DIM, dim)
            if wide not in codes:
                codes[wide] = [_code(wide, k) for k in range(CODES)]
            for s in range(0, len(at), 256):
                part = at[s:s + 256]
                for i, found in zip(part, list_decode(np.stack([rows[i] for i in part]), codes[wide])):
                    filters[i] = found
        packed = [rows[i].tobytes() if good[i] else None for i in range(n)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2),
            pa.array([len(x) if x is not None else 0 for x in rows], pa.int32()),
            pa.array(good), pa.array([hashlib.md5(x).digest() if x else None for x in packed], pa.binary()),
            pa.array(packed, pa.binary()), pa.array(filters, pa.list_(pa.int64()))],
            names=["id", "label", "n_dim", "ok", "digest", "vec", "filters"])


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _star_links(threshold: float):
    """(u, v, vec_u, vec_v) -> pairs at or above the threshold."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _matrix(batch.column(2)), _matrix(batch.column(3))
            cosine = (a * b).sum(axis=1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
            good = pa.array(cosine >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)],
                                             names=["u", "v"])
    return run


def _unit_links(unit: pa.Table, threshold: float):
    """(ids, block a, block b, same, link matrix) of one unit."""
    ids, blocks = unit.column("id").to_numpy(), unit.column("block").to_numpy()
    x = _matrix(unit.column("vec"))
    norms = np.linalg.norm(x, axis=1)
    a, b, same = sides(blocks)
    linked = (x[a] @ x[b].T) / (norms[a][:, None] * norms[b][None, :]) >= threshold
    if same:
        np.fill_diagonal(linked, False)
    return ids, a, b, same, linked


def _cross_links(threshold: float):
    """Units of bucket members -> per vector, one link into every other component it meets there."""
    def run(batches):
        for unit in units(batches):
            comps = unit.column("comp").to_numpy()
            if len(comps) < 2 or (comps == comps[0]).all():
                continue
            ids, a, b, _, linked = _unit_links(unit, threshold)
            x, y = np.nonzero(linked & (comps[a][:, None] != comps[b][None, :]))
            # links between the same two components say the same: one of them is enough
            pairs = np.unique(np.sort(np.stack([comps[a][x], comps[b][y]], axis=1), axis=1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])
    return run


def _count_links(threshold: float):
    """Units of component members -> (id, links): linked vectors in the other block, class sizes counted."""
    def run(batches):
        for unit in units(batches):
            ids, a, b, same, linked = _unit_links(unit, threshold)
            sizes = unit.column("size").to_numpy()
            out = [(ids[a], linked @ sizes[b])]
            if not same:
                out.append((ids[b], linked.T @ sizes[a]))
            for i, n in out:
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(n.astype(np.int64))], names=["id", "links"])
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    base = vectors.select(F.col(id_col).cast("long"), F.col(vector_col), F.col(label_col).cast("string"))
    decoded = stored(base.mapInArrow(_decode, DECODED), "cap-decoded")
    classes = stored(decoded.filter("ok and id is not null").groupBy("label", "digest")
                     .agg(F.min("id").alias("rep"), F.count("*").alias("size")), "cap-classes")
    reps = (decoded.join(classes, ["label", "digest"]).filter(F.col("id") == F.col("rep"))
            .dropDuplicates(["label", "digest", "id"]))
    vecs = stored(reps.select("id", "vec", "size"), "cap-vectors")
    rows = reps.select("id", F.explode("filters").alias("f"), "label", "n_dim").select(
        "id", F.xxhash64("label", "n_dim", "f").alias("bucket"))
    buckets = stored(rows.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("top"),
                                                F.count("*").alias("n"))
                     .filter(F.col("pivot") < F.col("top")).select("bucket", "pivot", "n"), "cap-buckets")
    members = stored(rows.join(buckets, "bucket"), "cap-members")
    stars = members.filter(F.col("id") != F.col("pivot")).select(F.col("pivot").alias("u"), F.col("id").alias("v")).distinct()
    named = vecs.select("id", "vec")
    stars = (stars.join(named.toDF("v", "vec_v"), "v").join(named.toDF("u", "vec_u"), "u")
             .select("u", "v", "vec_u", "vec_v").mapInArrow(_star_links(threshold), "u long, v long"))
    first = stored(connected_components(stars), "cap-first")

    placed = stored(members.select("bucket", "id", "n").join(first, F.col("id") == F.col("node"), "left")
                    .select("bucket", "id", "n", F.coalesce("component", "id").alias("comp")), "cap-placed")
    mixed = stored(placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                   .filter(F.col("low") < F.col("high")).select("bucket"), "cap-mixed")
    suspects = placed.join(mixed, "bucket", "left_semi").join(named, "id")
    cross = (block_pairs(suspects, "bucket", "n", BLOCK_ROWS, ["comp", "vec"])
             .mapInArrow(_cross_links(threshold), "u long, v long").distinct())
    comps = stored(connected_components(
        first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(cross)), "cap-components")

    sizes = comps.groupBy("component").agg(F.count("*").alias("n"))
    grouped = comps.join(sizes, "component").withColumnRenamed("node", "id").join(vecs, "id")
    links = (block_pairs(grouped, "component", "n", BLOCK_ROWS, ["vec", "size"])
             .mapInArrow(_count_links(threshold), "id long, links long")
             .groupBy("id").agg(F.sum("links").alias("links")))
    found = comps.join(links.withColumnRenamed("id", "node"), "node", "left")
    out = (decoded.select("id", "label", "digest").join(classes, ["label", "digest"], "left")
           .join(found, F.col("rep") == F.col("node"), "left")
           .select(F.col("id").alias(id_col),
                   (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))).cast("long").alias("n_links"),
                   F.coalesce("component", "rep", "id").alias("component_id")))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))

