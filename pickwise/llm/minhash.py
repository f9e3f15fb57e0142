"""MinHash near-dedup: universal hash minima, banding, verification, connected components.

A document's set holds its distinct 5-word shingles (lower-cased in A-Z, words
cut at ASCII blanks). Documents with equal sets form a class, which goes by the number
of one of its rows and is compared once, by the text of its smallest id. ``BANDS`` x ``ROWS``
multiply-shift minima per class are cut into bands; classes that share a band are
candidates. Links are confirmed on the full sets. In the end classes that share an
id are joined, and components are named after their smallest id.

Candidates are compared in two passes, so that a large group of near copies
never spells out its pairs:

1. every member of a band bucket is compared with the bucket's smallest id, and
   the confirmed links are joined into components;
2. only members of one bucket that lie in different components are compared
   with each other, in blocks of bounded size: by their signatures first, then
   the members of the pairs that pass on their full sets. A block returns its
   members or a spanning forest of its links, never its pairs; the components
   are joined again.

After the second pass every candidate pair has been confirmed, refuted, or lies
within one component, which is all that the result depends on.

With 36 bands of 6 rows a pair at similarity 0.85 shares no band with
probability (1 - 0.85^6)^36 = 4e-8; the signature test drops a pair whose
minima agree on under 65 % of the rows, 8 standard deviations below 0.85.
Signature bytes are taken from the minima, so a pair that shares a band may be
refuted by them but never gains similarity.

Defined cases: a null or empty text, and one of blanks only, has an empty set,
is linked with nothing and is its own component; a text of fewer words than a
shingle has one shingle, the whole sequence; rows with equal ids share one
component, which all their texts link to others, and each keeps its own set size;
a null id is kept as a row without links, and its component is null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.blocks import block_pairs, sides, units
from pickwise.llm.components import connected_components
from pickwise.llm.storage import stored
from pickwise.llm.words import WordHashes, blank_words, shingle_set

BANDS, ROWS, SHINGLE = 36, 6, 5
CHUNK_SHINGLES = 32_768
BLOCK_ROWS = 256  # members of one bucket compared with as many others at once
SIGNATURE_LEAST = 0.65 / 0.85  # of the threshold

_rng = np.random.default_rng(7_2024)
_A = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal hashes (a x + b) mod 2^64 over non-empty sets, one row per set."""
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    start = 0
    while start < len(sets):
        stop, n = start, 0
        while stop < len(sets) and (n == 0 or n + len(sets[stop]) <= CHUNK_SHINGLES):
            n += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[start:stop])
        at = np.cumsum([0] + [len(s) for s in sets[start:stop - 1]])
        for k in range(BANDS * ROWS):
            y = x * _A[k]
            y += _B[k]
            out[start:stop, k] = np.minimum.reduceat(y, at)
        start = stop
    return out


def _band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band; the band number is mixed in."""
    keys = np.zeros((len(low), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(low), (b + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1), np.uint64)
        for r in range(ROWS):
            h = (h ^ low[:, b * ROWS + r]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
        keys[:, b] = h
    return keys.view(np.int64)


SIGNED = "id long, mark long, n_shingles long, digest binary, bands array<long>, signature binary"


def _sign(batches):
    hashes = WordHashes()
    for batch in batches:
        ids, marks, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        sets = [shingle_set(hashes.of(blank_words(t or b"")), SHINGLE) for t in texts]
        full = [s for s in sets if len(s)]
        low = minima(full) if full else np.empty((0, BANDS * ROWS), np.uint64)
        bands = iter(_band_keys(low).tolist())
        # one byte of each minimum suffices for the signature: unequal minima agree in it once in 256 times
        short = iter(np.ascontiguousarray((low >> np.uint64(24)).astype(np.uint8)))
        yield pa.RecordBatch.from_arrays([
            ids, marks, pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
            pa.array([next(short).tobytes() if len(s) else None for s in sets], pa.binary()),
        ], names=["id", "mark", "n_shingles", "digest", "bands", "signature"])


def _confirm(threshold: tuple[int, int]):
    """(u, v, text_u, text_v) -> the pairs with p * |intersection| >= q * |union|, by integers."""
    p, q = threshold

    def run(batches):
        hashes, last, kept = WordHashes(), None, None
        for batch in batches:
            us, vs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for i, (u, a, b) in enumerate(zip(us, batch.column(2), batch.column(3))):
                if u != last:
                    last, kept = u, shingle_set(hashes.of(blank_words(a.as_py())), SHINGLE)
                other = shingle_set(hashes.of(blank_words(b.as_py())), SHINGLE)
                small, large = sorted((len(kept), len(other)))
                if p * small < q * large:
                    continue
                both = len(np.intersect1d(kept, other, assume_unique=True))
                if p * both >= q * (small + large - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([us[i] for i in good], pa.int64()),
                                              pa.array([vs[i] for i in good], pa.int64())], names=["u", "v"])
    return run


def _suspects(unit: pa.Table, least: float):
    """(ids, components, x, y) of a unit: rows of the pairs to confirm.

    They lie in different components, their signatures agree enough, and the
    unit's band is the first that they share, so each pair is met once.
    """
    ids, comps, blocks = (unit.column(c).to_numpy() for c in ("id", "comp", "block"))
    none = np.empty(0, np.int64)
    if len(ids) < 2 or (comps == comps[0]).all():
        return ids, comps, none, none
    signatures = np.frombuffer(b"".join(unit.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
    bands = unit.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    key, need = unit.column("key")[0].as_py(), math.ceil(least * signatures.shape[1])
    a, b, same = sides(blocks)
    xs, ys = [none], [none]
    step = max(1, (32 << 20) // (len(b) * signatures.shape[1]))
    for s in range(0, len(a), step):
        part = a[s:s + step]
        hit = comps[part][:, None] != comps[b][None, :]
        if same:
            hit &= part[:, None] < b[None, :]
        hit &= (signatures[part][:, None, :] == signatures[b][None, :, :]).sum(axis=2, dtype=np.int32) >= need
        x, y = np.nonzero(hit)
        x, y = part[x], b[y]
        first = (bands[x] == bands[y]).argmax(axis=1)
        mine = bands[x, first] == key
        xs.append(x[mine])
        ys.append(y[mine])
    return ids, comps, np.concatenate(xs), np.concatenate(ys)


def _flag(least: float):
    """Units -> (band, id) of the members of any pair to confirm."""
    def run(batches):
        for unit in units(batches):
            ids, _, x, y = _suspects(unit, least)
            if len(x):
                found = np.unique(ids[np.concatenate((x, y))])
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(unit.column("key")[0], len(found)), pa.array(found)], names=["band", "id"])
    return run


def shared_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (x, y), by products of 0/1 matrices."""
    if len(x) <= 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y)], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    often = times[column] > 1
    owner, column = owner[often], (np.cumsum(times > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 16_384):
        lo, hi = np.searchsorted(column, (start, start + 16_384))
        held = np.zeros((len(sets), 16_384), np.float32)
        held[owner[lo:hi], column[lo:hi] - start] = 1
        both += held @ held.T
    return both[x, y].astype(np.int64)


def _confirm_units(least: float, threshold: tuple[int, int]):
    """Units with texts -> links between components, a spanning forest of them per unit."""
    p, q = threshold

    def run(batches):
        hashes = WordHashes()
        for unit in units(batches):
            ids, comps, x, y = _suspects(unit, least)
            if not len(x):
                continue
            used, at = np.unique(np.concatenate((x, y)), return_inverse=True)
            texts = unit.column("text").take(pa.array(used)).to_pylist()
            sets = [shingle_set(hashes.of(blank_words(t)), SHINGLE) for t in texts]
            sizes = np.array([len(s) for s in sets])
            x, y = at[:len(x)], at[len(x):]
            both = shared_counts(sets, x, y)
            linked = p * both >= q * (sizes[x] + sizes[y] - both)
            up = {}

            def root(c):
                while up.get(c, c) != c:
                    c = up[c]
                return c
            for u, v in zip(comps[used[x[linked]]].tolist(), comps[used[y[linked]]].tolist()):
                u, v = sorted((root(u), root(v)))
                if u != v:
                    up[v] = u
            if up:
                yield pa.RecordBatch.from_arrays([pa.array(list(up.values()), pa.int64()),
                                                  pa.array(list(up), pa.int64())], names=["u", "v"])
    return run


def _similar_signatures(least: float):
    """(u, v, signature_u, signature_v) -> the pairs with enough equal minima."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in (2, 3))
            good = pa.array((a == b).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)],
                                             names=["u", "v"])
    return run


def _attach(pairs: DataFrame, side: str, table: DataFrame, column: str) -> DataFrame:
    named = table.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}"))
    return pairs.join(named, side)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: tuple[int, int] = (100, 85)) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row; the threshold (p, q) means p * shared >= q * union."""
    least = SIGNATURE_LEAST * threshold[1] / threshold[0]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).select(
        "id", F.xxhash64("text").alias("mark"), "text")
    # rows get a number, fixed by being written; a class is a set and goes by the number of one row of it
    signed = stored(texts.mapInArrow(_sign, SIGNED).withColumn("row", F.monotonically_increasing_id()), "minhash-signed")
    named_rows = signed.filter("digest is not null and id is not null")
    narrow = named_rows.select("digest", "id", "mark", "row")
    first_row = (narrow.groupBy("digest", "id", "mark").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
                 .groupBy("digest").agg(F.min(F.struct("id", "mark", "row", "copies")).alias("r"), F.sum("copies").alias("n")))
    classes = stored(first_row.select("digest", F.col("r.id").alias("rep"), F.col("r.mark").alias("rep_mark"),
                                      F.col("r.row").alias("node"), F.col("r.copies").alias("copies"), "n"), "minhash-classes")
    # the other rows of a class are left out by their numbers: the wide rows need not move where these are few
    spare = stored(narrow.join(classes.filter("n > 1").select("digest", "node"), "digest")
                   .filter("row != node").select("row"), "minhash-spare")

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(id, text) of classes, one row each."""
        # stored, so that its size is known and the texts need not move where it is small
        named = stored(classes.join(nodes.select(F.col("id").alias("node")), "node").select("node", "rep", "rep_mark", "copies"),
                       "minhash-named")

        def found(some: DataFrame) -> DataFrame:
            return (texts.join(some, (F.col("id") == F.col("rep")) & (F.col("mark") == F.col("rep_mark")))
                    .select(F.col("node").alias("id"), "text"))
        again = named.filter("copies > 1")  # rows that come twice, id and text
        once = found(named.filter("copies = 1"))
        return once if again.isEmpty() else once.union(found(again).dropDuplicates(["id"]))
    rows = named_rows.select("row", "bands").join(spare, "row", "left_anti").select(
        F.col("row").alias("id"), F.explode("bands").alias("band"))
    bucket = Window.partitionBy("band")
    members = stored(rows.select("band", "id", F.min("id").over(bucket).alias("pivot"), F.count("*").over(bucket).alias("n"))
                     .filter("n > 1"), "minhash-members")
    ids = stored(members.select("id").distinct(), "minhash-ids")
    signatures = stored(signed.select(F.col("row").alias("id"), "signature", "bands").join(ids, "id", "left_semi"),
                        "minhash-signatures")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        pairs = stored(pairs, f"{name}-pairs")
        wanted = stored(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), f"{name}-ids")
        held = stored(texts_of(wanted), f"{name}-texts")
        both = _attach(_attach(pairs, "v", held, "text"), "u", held, "text")
        return stored(both.select("u", "v", "text_u", "text_v")
                      .mapInArrow(_confirm(threshold), "u long, v long"), f"{name}-links")

    # first pass: every member against the smallest id of its bucket
    stars = members.filter(F.col("id") != F.col("pivot")).select(F.col("pivot").alias("u"), F.col("id").alias("v")).distinct()
    stars = _attach(_attach(stars, "v", signatures, "signature"), "u", signatures, "signature")
    stars = stars.select("u", "v", "signature_u", "signature_v").mapInArrow(_similar_signatures(least), "u long, v long")
    first = connected_components(confirm(stars, "minhash-first"))

    # second pass: members of one bucket in different components
    placed = stored(members.select("band", "id", "n").join(first, F.col("id") == F.col("node"), "left")
                    .select("band", "id", "n", F.coalesce("component", "id").alias("comp")), "minhash-placed")
    mixed = stored(placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                   .filter(F.col("low") < F.col("high")).select("band"), "minhash-mixed")
    carried = ["comp", "signature", "bands"]
    suspects = placed.join(mixed, "band", "left_semi")
    flagged = stored(block_pairs(suspects.join(signatures, "id"), "band", "n", BLOCK_ROWS, carried)
                     .mapInArrow(_flag(least), "band long, id long").distinct(), "minhash-flagged")
    wanted = stored(flagged.select("id").distinct(), "minhash-second-ids")
    held = stored(texts_of(wanted), "minhash-second-texts")
    closer = suspects.join(flagged, ["band", "id"], "left_semi").join(signatures, "id").join(held, "id")
    second = (block_pairs(closer, "band", "n", BLOCK_ROWS, [*carried, "text"])
              .mapInArrow(_confirm_units(least, threshold), "u long, v long").distinct())
    # an id with several sets links them
    mine = stored(signed.filter("digest is not null and id is not null").select("id", "digest").distinct()
                  .join(classes.select("digest", "node"), "digest").groupBy("id")
                  .agg(F.min("node").alias("u"), F.max("node").alias("top"), F.collect_set("node").alias("nodes"))
                  .filter("u < top").select("u", F.explode("nodes").alias("v")).filter("u < v").distinct(), "minhash-ids-of-sets")
    edges = first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(second).union(mine)
    comps = stored(connected_components(edges), "minhash-components")
    smallest = (comps.join(classes.select("node", "rep"), "node").groupBy("component")
                .agg(F.min("rep").alias("component_id")))
    named = classes.join(comps.join(smallest, "component").select("node", "component_id"), "node", "left").select(
        "digest", F.coalesce("component_id", "rep").alias("component_id"))
    out = (signed.select("id", "n_shingles", "digest").join(named, "digest", "left")
           .select(F.col("id").alias(id_col), "n_shingles",
                   F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
