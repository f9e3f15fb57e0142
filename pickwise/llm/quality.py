"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a document are its words, their written shape (case, digits, the
marks behind them), and the levels of immediate repetition and of variety that
it reaches, hashed into ``FEATURES`` columns. Log counts weighted by inverse document
frequency are projected on the leading singular vectors of a bounded, seeded
sample of labelled training rows. Every document is compared with all sample
vectors by exact cosine products, block by block; the labels of the ``k``
nearest are weighted by a power of their similarity and summed to a score.

Bounds: at most ``SAMPLE_ROWS`` labelled rows are fitted and broadcast
(8192 x 48 floats, 1.6 MB, plus the 4096 x 48 projection, 0.8 MB), whatever the
size of the tables. Labels, language, source and id are no inputs of a score.

Defined cases: a null text is empty; an empty text, or one without a known
term, has no direction and scores the sample's mean label; without any labelled
training row every score is 0.5; rows with equal ids are scored by their own
texts; labels that are null or whose document is missing are ignored, equal
label rows count once, and of contradicting ones the larger counts; an empty
table gives no rows; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 8192
FEATURES, WORDS, SHAPES = 4096, 3072, 1000
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 4.0
BLOCK = 512
SEED = 20240917
CACHE_WORDS = 400_000
EMPTY = np.zeros(0, np.int64)


# levels of immediate repetition and of word variety that become terms of their own
REPEATED = (0.02, 0.05, 0.1, 0.2, 0.4)
VARIETY = (0.5, 0.3, 0.15)
_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())


class _Codes(dict):
    """word -> (hash of the bare word, hash of its shape) in one integer.

    The shape is the case of the word and the first marks behind it.
    """

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        core = word.rstrip(_MARKS)
        kind = 3 if core.isdigit() else 2 if core.isupper() else 1 if core[:1].isupper() else 0
        shape = xxhash.xxh32_intdigest(word[len(core):len(core) + 3], kind) % SHAPES
        self[word] = code = (xxhash.xxh3_64_intdigest(core.lower()) >> 24) << 20 | shape
        return code

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def term_counts(text: bytes, codes: _Codes) -> tuple[np.ndarray, np.ndarray]:
    """(columns, log counts) of one text."""
    c = codes.of(text)
    n = len(c)
    if not n:
        return EMPTY, EMPTY.astype(np.float32)
    bare, shape = c >> 20, c & 0xFFFFF
    counts = np.bincount(bare % WORDS, minlength=FEATURES)
    counts[WORDS:WORDS + SHAPES] += np.bincount(shape, minlength=SHAPES)
    repeated = int((bare[1:] == bare[:-1]).sum()) / n
    variety = len(np.unique(bare)) / n if n >= 20 else 1.0
    levels = [repeated >= x for x in REPEATED] + [variety <= x for x in VARIETY]
    counts[FEATURES - len(levels):] = np.array(levels) * n
    at = np.flatnonzero(counts)
    # relative log counts: the length of a text alone moves it little
    return at, np.log1p(counts[at] * (256.0 / (n + 32.0))).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> dict:
    """Inverse frequencies, projection, unit sample vectors and labels from the sampled rows."""
    labels = np.array([r[2] for r in rows], np.float32)
    rows_, labels_ = [r for r in rows if len(r[0])], np.array([r[2] for r in rows if len(r[0])], np.float32)
    prior = float(labels.mean()) if len(labels) else 0.5
    if not rows_:
        return {"prior": prior, "idf": None}
    frequency = np.zeros(FEATURES)
    for at, _, _ in rows_:
        frequency[at] += 1
    idf = (np.log((1 + len(rows_)) / (1 + frequency)) + 0.1).astype(np.float32)
    weighted = []
    for at, x, _ in rows_:
        y = x * idf[at]
        weighted.append((at, y / max(float(np.linalg.norm(y)), 1e-12)))

    def dense_blocks():
        # the sample is dense in blocks only, so that the driver never holds it whole
        for start in range(0, len(weighted), BLOCK):
            part = weighted[start:start + BLOCK]
            block = np.zeros((len(part), FEATURES), np.float32)
            for i, (at, y) in enumerate(part):
                block[i, at] = y
            yield block

    # randomised range finder with power steps, then the small problem exactly
    rank = min(RANK, len(rows_))
    basis = np.random.default_rng(SEED).standard_normal((FEATURES, rank + 16), np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(sum(block.T @ (block @ basis) for block in dense_blocks()))
    small = np.concatenate([block @ basis for block in dense_blocks()])
    _, _, right = np.linalg.svd(small, full_matrices=False)
    projection = (basis @ right.T)[:, :rank]
    vectors = small @ right.T[:, :rank]
    norms = np.linalg.norm(vectors, axis=1)
    good = norms > 1e-9
    return {"prior": prior, "idf": idf, "projection": (idf[:, None] * projection).astype(np.float32),
            "vectors": (vectors[good] / norms[good, None]).astype(np.float32), "labels": labels_[good]}


def vote(model: dict, terms: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores of documents from their terms, by exact cosines with all sample vectors."""
    scores = np.full(len(terms), model["prior"])
    if model["idf"] is None:
        return scores
    own = np.zeros((len(terms), model["projection"].shape[1]), np.float32)
    for i, (at, x) in enumerate(terms):
        if len(at):
            own[i] = x @ model["projection"][at]
    norms = np.linalg.norm(own, axis=1)
    k = min(NEIGHBOURS, len(model["labels"]))
    for start in range(0, len(terms), BLOCK):
        rows = np.flatnonzero(norms[start:start + BLOCK] > 1e-9) + start
        if not len(rows) or not k:
            continue
        cosine = (own[rows] / norms[rows, None]) @ model["vectors"].T
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** SHARPNESS
        scores[rows] = (weight * model["labels"][near]).sum(axis=1) / weight.sum(axis=1)
    return scores


def held_out(id_col: str | Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 by 3."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Fit on at most ``sample_rows`` labelled ids outside the held-out fold, in a seeded random order.

    An id with several texts gives one of them, by the smallest hash, so at most ``sample_rows`` rows are fitted.
    """
    known = (labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label")))
    order = F.xxhash64("_id", F.lit(SEED))
    sample = known.withColumn("_order", order).orderBy("_order", "_id").limit(sample_rows)
    picked = (docs.join(F.broadcast(sample), docs[id_col] == F.col("_id"))  # sample_rows rows at most
              .groupBy("_order", "_id", "_label")
              .agg(F.min_by(F.coalesce(F.col(text_col), F.lit("")), F.xxhash64(text_col)).cast("binary").alias("_text"))
              .select("_order", "_label", "_text"))

    def terms(batches):
        codes = _Codes()
        for batch in batches:
            found = [term_counts(t or b"", codes) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([f[0].astype(np.int16).tobytes() for f in found], pa.binary()),
                pa.array([f[1].tobytes() for f in found], pa.binary())], names=["order", "label", "at", "x"])

    found = picked.mapInArrow(terms, "order long, label int, at binary, x binary").collect()
    sample = sorted(found, key=lambda r: (r["order"], bytes(r["at"]), bytes(r["x"])))
    return fit([(np.frombuffer(r["at"], np.int16).astype(np.int64), np.frombuffer(r["x"], np.float32), r["label"])
                for r in sample])


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 (in place of one of that name)."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, see above
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])

    def run(batches):
        codes, model = _Codes(), shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            scores = vote(model, [term_counts(t or b"", codes) for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)
