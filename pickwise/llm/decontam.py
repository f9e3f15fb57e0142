"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items form one suffix automaton; each
document streams its words through it and keeps the longest match that ends at
every word. Where the match is as long as a window (13 words, or a whole item
of fewer), the window's words are hit. Spans are maximal runs of hit words; a
document whose hit words exceed the coverage limit is contaminated.

The automaton is built on the driver and broadcast, so its size is checked: a
benchmark of more than ``SHARD_WORDS`` words is split by item into shards, an
item of more into pieces that share a window less one word, and the shards are
scanned one after the other, their spans merged per document.

Defined cases: a null or empty text has no words; an item without words has no
window; items with equal texts all count; item ids are compared as strings, a
null one is the empty string; rows with equal document ids stay rows of their
own, told apart by a hash of their texts (equal rows share equal results); an empty benchmark hits nothing; an
empty document table gives no rows; other columns are kept by
``decontaminate`` and ignored by ``scan``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.words import alnum_words

WINDOW = 13
COVERAGE = 20  # contaminated: at least one word in 20 is hit
SHARD_WORDS = 250_000  # about 250 MB of tables in the driver and in each Python worker
SCANNED = pa.schema([("id", pa.int64()), ("n_words", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     ("items", pa.list_(pa.string())), ("mark", pa.binary())])


class SuffixAutomaton:
    """Words of several items; matches never run from one item into the next."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
                 for name, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # windows by the state that holds them: state -> {length: item names}
        self.windows: dict[int, dict[int, set[str]]] = {}
        for name, codes in coded:
            size = min(window, len(codes))
            state = length = 0
            for c in codes:
                state, length = self.step(state, length, c)
                if length >= size:
                    self.windows.setdefault(self._holder(state, size), {}).setdefault(size, set()).add(name)
        self.shortest = min((min(window, len(codes)) for _, codes in coded), default=0)
        # every window that ends where a state's matches end: own and along the suffix links
        self.ending: list[tuple] = [()] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            above = self.ending[self.link[state]] if self.link[state] > 0 else ()
            own = tuple(sorted((n, tuple(sorted(names))) for n, names in self.windows.get(state, {}).items()))
            self.ending[state] = above + own
        del self.windows

    @classmethod
    def from_tables(cls, tables: dict) -> SuffixAutomaton:
        automaton = cls.__new__(cls)
        automaton.__dict__.update(tables)
        return automaton

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # the item shares this prefix with an earlier one
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return new

    def _clone(self, p: int, q: int, c: int) -> int:
        twin = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        nxt, link = self.next, self.link
        while c not in nxt[state]:
            state = link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return nxt[state][c], length + 1

    def _holder(self, state: int, size: int) -> int:
        """The state whose matches include the suffix of ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words (start, end) and the names of the items with a window there."""
        get = self.vocabulary.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        spans: list[list[int]] = []
        names: set[str] = set()
        if not self.shortest or not len(codes):
            return [], names
        # only runs of known words that are as long as the shortest window can hold one
        known = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0]))))
        for start, end in zip(known[::2].tolist(), known[1::2].tolist()):
            if end - start < self.shortest:
                continue
            state = length = 0
            for i, c in enumerate(codes[start:end].tolist(), start):
                state, length = self.step(state, length, c)
                if length >= self.shortest and self.ending[state]:
                    for size, items in self.ending[state]:
                        if size <= length:
                            names.update(items)
                            left = i + 1 - size
                            while spans and spans[-1][0] >= left:
                                spans.pop()
                            if spans and spans[-1][1] >= left:
                                spans[-1][1] = i + 1
                            else:
                                spans.append([left, i + 1])
        return [tuple(s) for s in spans], names


def pieces(words: list[bytes], most: int, window: int) -> list[list[bytes]]:
    """Words cut into runs of at most ``most`` that share ``window`` - 1 words, so that each window lies in one."""
    if len(words) <= most:
        return [words]
    step = most - window + 1
    return [words[at:at + most] for at in range(0, len(words) - window + 1, step)]


def _shards(benchmark: DataFrame, item_col: str, text_col: str, shard_words: int, window: int):
    """Lists of (item name, words) of at most ``shard_words`` words each; a longer item is cut into pieces."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(text_col).cast("binary").alias("text")).orderBy("item", "text")
    shard, held = [], 0
    for r in items.toLocalIterator():
        for words in pieces(alnum_words(bytes(r["text"] or b"")), max(shard_words, 2 * window), window):
            if shard and held + len(words) > shard_words:
                yield shard
                shard, held = [], 0
            shard.append((r["item"], words))
            held += len(words)
    yield shard


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
         coverage: int = COVERAGE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, n_words, spans array<struct<start, end>>, items array<string>, mark, n_hit, contaminated) per row.

    ``mark`` is the text's MD5 (of no bytes for a null text); it tells rows of one id apart.
    """
    spark = docs.sparkSession
    schema = "id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, mark binary"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    parts = []
    for shard in _shards(benchmark, item_col, item_text_col, shard_words, window):
        shared = spark.sparkContext.broadcast(vars(SuffixAutomaton(shard, window)))

        def run(batches, shared=shared):
            automaton = SuffixAutomaton.from_tables(shared.value)
            for batch in batches:
                out = []
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = text.as_py() or b""
                    words = alnum_words(text)
                    spans, names = automaton.scan(words)
                    out.append({"id": i, "n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans],
                                "items": sorted(names), "mark": hashlib.md5(text).digest()})
                yield pa.RecordBatch.from_pylist(out, schema=SCANNED)
        parts.append(rows.mapInArrow(run, schema))
    out = parts[0]
    if len(parts) > 1:
        out = _merge(parts, schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (out.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words")))
            .withColumnRenamed("id", id_col))


def text_mark(text: Column) -> Column:
    """The MD5 by which ``scan`` tells texts apart."""
    return F.unhex(F.md5(F.coalesce(text.cast("binary"), F.lit(b""))))


def _merge(parts: list[DataFrame], schema: str) -> DataFrame:
    """Spans and items of the shards per document; equal rows stay as many as they were."""
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    merged = found.groupBy("id", "mark").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / len(parts)).cast("int").alias("copies"))

    def join(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans: list[dict] = []
                for s in row["spans"]:
                    if spans and s["start"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], s["end"])
                    else:
                        spans.append(s)
                out += [{**row, "spans": spans}] * row.pop("copies")
            yield pa.RecordBatch.from_pylist(out, schema=SCANNED)
    return merged.mapInArrow(join, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  action: str = "drop", window: int = WINDOW, coverage: int = COVERAGE, **scan_options) -> DataFrame:
    """``docs`` without contaminated documents (``drop``) or without their hit spans (``cut``).

    Documents under the coverage limit stay as they are in either case. ``cut``
    keeps the words outside the spans, lower-cased and joined by one blank.
    """
    found = scan(docs, benchmark, id_col, text_col, window=window, coverage=coverage, **scan_options)
    bad = found.filter("contaminated").select(F.col(id_col).alias("_id"), F.col("mark").alias("_mark"),
                                              F.col("spans").alias("_spans")).dropDuplicates(["_id", "_mark"])
    same = (docs[id_col].cast("long").eqNullSafe(F.col("_id"))
            & (text_mark(docs[text_col]) == F.col("_mark")))
    if action == "drop":
        return docs.join(bad, same, "left_anti")
    # the words as the scan saw them, without those inside a span
    low = F.regexp_replace(F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                           "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")
    words = F.split(F.trim(low), " ")
    kept = F.filter(words, lambda _, i: ~F.exists("_spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    out = docs.join(bad, same, "left")
    return out.select(*[F.when(F.col("_spans").isNotNull(), F.array_join(kept, " ")).otherwise(F.col(c)).alias(c)
                        if c == text_col else F.col(c) for c in docs.columns])
