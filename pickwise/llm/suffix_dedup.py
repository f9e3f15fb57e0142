"""Suffix-array dedup: byte strings of 200 that occur twice, by a distributed merge sort of suffixes.

Not every suffix is sorted. A position is an *anchor* if the hash of its 8
bytes is the least within some window of ``SPREAD`` consecutive positions; the
rule looks at the bytes alone, so equal strings have anchors at equal offsets,
and every 200-byte string has one among its first ``SPREAD`` positions. Two
equal 200-byte strings therefore show as two anchors whose right sides agree in
r bytes and whose left sides agree in l bytes with l + r >= 200; as l < SPREAD,
the right sides agree in ``LEAST_RIGHT`` = 200 - SPREAD + 1 bytes at least.

1. *Candidates*: the first ``LEAST_RIGHT`` bytes of the right sides are hashed
   and counted; anchors whose hash occurs once cannot match and are left out.
2. *Runs*: each task sorts the distinct contexts (the bytes to the left and the
   200 to the right) of its candidate anchors by their right sides, and sends
   them out as sorted runs, front-coded: a suffix is its common prefix length
   with the one before and the remaining bytes. Runs are cut into ranges by the
   candidate hash, so that anchors that can match meet in one range.
3. *Merge*: a loser tree merges the runs of a range. It carries the common
   prefix length of every head with the last winner; two heads that differ in
   it are ordered without touching their bytes, and bytes within a known common
   prefix are never compared again.
4. *Match*: in the merged order, neighbours with ``LEAST_RIGHT`` common bytes
   form groups. For every level r of common right bytes in a group, the best
   common left bytes l of each context come from its neighbours in the order of
   the left sides; l + r >= 200 covers l bytes before the anchor and r from it on.
5. What is covered returns to the anchors with the same context and is joined
   into spans per document.

Equal texts are removed whole (if they have 200 bytes) and only one of them
takes part in the search. A context that occurs often in a task is sent once,
and its anchors stay behind, so that a passage found in every document costs
each task one context for every anchor in it.

The texts are moved once, into buckets by row number. What the search finds by
row is dealt to the same buckets, so neither the search nor the cut shuffles texts.

A merge range holds all contexts of a candidate hash, so the hash must not have
more of them than ``CROWD``. Anchors of the few that do (the edges of a passage
that stands in very many documents, with other surroundings in each) leave the
merge, and the 200-byte strings around them are counted by two 64-bit hashes in
an aggregation, which no single task has to hold. Equal strings have equal
anchors, so both places of a match are always counted in the same way. The
strings with an anchor among their bytes ``CLASS`` j to ``CLASS`` (j + 1) - 1 share
``CLASS_BYTES`` bytes around it, which are counted first, one row per j: only
where these occur twice, the strings themselves are.

Defined cases: a null text is empty; texts under 200 bytes lose nothing; rows
with equal ids are documents of their own, told apart by a 128-bit digest of their
texts (inside the search a text goes by the number of its stored row); a null id
is a value like any other; an empty table gives no rows; other columns are
ignored. Matches never cross documents; strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.storage import stored, stored_in_buckets

LENGTH, SPREAD = 200, 152
LEFT, LEAST_RIGHT = SPREAD - 1, LENGTH - SPREAD + 1  # 151 bytes before an anchor, 49 from it on
RUN_CONTEXTS = 100_000  # contexts sorted at once in a task
RANGE_CONTEXTS = 40_000  # aimed at in one range of the merge
CROWD = 40_000  # contexts of one candidate hash that a range takes
SMALL_GROUP = 12
BUCKET_BYTES = 16 << 20  # of texts aimed at in one bucket of the stored rows, and in those of small tables
SMALL_BUCKET_BYTES = 1 << 20
CLASS = 19  # places of an anchor in a string that are ruled out together
CLASS_BYTES = LENGTH - CLASS + 1  # bytes around an anchor that all strings of one class share


def _grams(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as one number each."""
    n = len(b) - 7
    out = b[:n].astype(np.uint64)
    for k in range(1, 8):
        out |= b[k:n + k].astype(np.uint64) << np.uint64(8 * k)
    return out


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Least or greatest of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[:len(x) - step], x[step:])
        have += step
    return x


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes of the ``LEAST_RIGHT`` bytes from there on) of a text of 200 bytes or more."""
    b = np.frombuffer(text, np.uint8)
    grams = _grams(b)
    h = ((grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
    h = h[:len(b) - LEAST_RIGHT + 1]
    low = _sliding(h, SPREAD, np.minimum)
    # a position is an anchor if it equals the least of some window over it, the greatest of those leasts
    edge = np.zeros(SPREAD - 1, np.uint32)
    top = _sliding(np.concatenate((edge, low, edge)), SPREAD, np.maximum)
    at = np.flatnonzero(top == h)
    key = np.full(len(at), 0x51ED270B, np.uint64)
    for k in (*range(0, LEAST_RIGHT - 8, 8), LEAST_RIGHT - 8):
        key = (key ^ grams[at + k]) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return at, key.view(np.int64)


def lcp(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    end = min(len(a), len(b))
    while start < end:
        stop = min(end, start + 32)
        if a[start:stop] == b[start:stop]:
            start = stop
            continue
        x = int.from_bytes(a[start:stop], "little") ^ int.from_bytes(b[start:stop], "little")
        return start + ((x & -x).bit_length() - 1) // 8
    return end


class LoserTree:
    """Merges sorted streams of (common prefix with the one before, item); items start with their text.

    The tree holds, per inner node, the stream that lost there. Every head
    knows its common prefix with the winner last given out: of two heads the one
    with the longer is the smaller, and only equal ones are compared, from that
    length on.
    """

    def __init__(self, streams):
        self.streams = [iter(s) for s in streams]
        size = 1
        while size < len(self.streams):
            size *= 2
        self.size = size
        self.heads: list = [None] * size
        self.known = [0] * size
        for i, s in enumerate(self.streams):
            self.heads[i] = next(s, None)
            if self.heads[i] is not None:
                self.heads[i] = self.heads[i][1]
        self.losers = [0] * size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = self._play(a, b)
        self.losers[node] = lose
        return win

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        known = self.known
        if known[a] != known[b]:  # the loser's prefix with the winner is its own, the shorter one
            return (a, b) if known[a] > known[b] else (b, a)
        s, t = x[0], y[0]
        n = lcp(s, t, known[a])
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def __iter__(self):
        """(common prefix with the item before, item) in order."""
        before = 0
        while self.heads[w := self.winner] is not None:
            yield before, self.heads[w]
            item = next(self.streams[w], None)
            if item is None:
                self.heads[w] = None
            else:
                self.known[w], self.heads[w] = item
            node = (w + self.size) // 2
            while node:
                w, self.losers[node] = self._play(w, self.losers[node])
                node //= 2
            self.winner = w
            before = self.known[w]


def front_code(rights: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted strings -> (common prefix with the one before, the rest)."""
    shared = [0] + [lcp(a, b) for a, b in zip(rights, rights[1:])]
    return shared, [r[n:] for r, n in zip(rights, shared)]


def match_group(rights: list[int], lefts: list[bytes]) -> list[tuple[int, int]]:
    """(bytes before, bytes from it on) that the best matches cover, for neighbours with ``LEAST_RIGHT`` common bytes.

    ``rights[i]`` is the common right prefix with the member before; ``lefts``
    are reversed left sides. A member without a match of 200 bytes gets (0, 0).
    All matches of a member hold its anchor, so their union is one interval.
    """
    n = len(lefts)
    before, after = [0] * n, [0] * n
    if n <= SMALL_GROUP:
        for i in range(n):
            r = LENGTH
            for j in range(i + 1, n):
                r = min(r, rights[j])
                m = lcp(lefts[i], lefts[j])
                if m + r >= LENGTH:
                    for k in (i, j):
                        before[k], after[k] = max(before[k], m), max(after[k], r)
        return list(zip(before, after))
    place = np.empty(n, np.int64)
    place[sorted(range(n), key=lefts.__getitem__)] = np.arange(n)
    wide = np.zeros((n, LEFT + 1), np.uint8)
    for i, x in enumerate(lefts):
        wide[i, :len(x)] = np.frombuffer(x, np.uint8)
    size, shared = np.array([len(x) for x in lefts]), np.array(rights)
    most_before, most_after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # runs of members that share at least r right bytes, from the whole group down
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        r = int(shared[lo + 1:hi].min())
        members = np.argsort(place[lo:hi]) + lo
        a, b = members[:-1], members[1:]
        same = np.empty(len(a), np.int64)
        for s in range(0, len(a), 16_384):
            differ = wide[a[s:s + 16_384]] != wide[b[s:s + 16_384]]
            differ[:, LEFT] = True
            same[s:s + 16_384] = differ.argmax(axis=1)
        same = np.minimum(same, np.minimum(size[a], size[b]))  # the rows are padded with zeros
        best = np.zeros(hi - lo, np.int64)
        np.maximum.at(best, a - lo, same)
        np.maximum.at(best, b - lo, same)
        hit = np.flatnonzero(best + r >= LENGTH)
        most_before[hit + lo] = np.maximum(most_before[hit + lo], best[hit])
        most_after[hit + lo] = np.maximum(most_after[hit + lo], r)
        cuts = [lo, *(np.flatnonzero(shared[lo + 1:hi] == r) + lo + 1).tolist(), hi]
        todo += [(x, y) for x, y in zip(cuts, cuts[1:]) if y - x > 1]
    return list(zip(most_before.tolist(), most_after.tolist()))


def _anchor_rows(batches):
    """(row, text) -> (key, row, pos) of every anchor."""
    for batch in batches:
        keys, rows, places = [], [], []
        for row, text in zip(*(batch.column(c).to_pylist() for c in range(2))):
            at, key = anchors(text)
            keys.append(key)
            rows.append(np.full(len(at), row, np.int64))
            places.append(at.astype(np.int32))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, rows, places)],
                                             names=["key", "row", "pos"])


def _anchor_contexts(batches):
    """(text) -> (key, hash of the context) of every anchor."""
    import xxhash
    for batch in batches:
        for text in batch.column(0).to_pylist():
            at, key = anchors(text)
            contexts = [xxhash.xxh3_64_intdigest(text[max(0, p - LEFT):p + LENGTH], min(p, LEFT)) for p in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.array(contexts, np.uint64).view(np.int64))],
                                             names=["key", "context"])


def window_hashes(b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each of the 200-byte strings from ``starts`` on."""
    grams = _grams(b)
    one, two = np.full(len(starts), 0x51ED270B, np.uint64), np.full(len(starts), 0x2545F491, np.uint64)
    for k in range(0, LENGTH, 8):
        g = grams[starts + k]
        one = (one ^ g) * np.uint64(0xFF51AFD7ED558CCD)
        one ^= one >> np.uint64(32)
        two = (two ^ g) * np.uint64(0x9FB21C651E98DF25)
        two ^= two >> np.uint64(29)
    return one.view(np.int64), two.view(np.int64)


def _covered_starts(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All starts within the ranges from ``low`` to ``high`` (included); empty ranges count nothing."""
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, low[low <= high], 1)
    np.add.at(inside, high[low <= high] + 1, -1)
    return np.flatnonzero(np.cumsum(inside))


def windows(text: bytes, positions: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, hash, other hash) of the 200-byte strings with a position among their first ``SPREAD`` bytes."""
    b, p = np.frombuffer(text, np.uint8), np.array(positions)
    starts = _covered_starts(len(b), np.maximum(p - LEFT, 0), np.minimum(p, len(b) - LENGTH))
    return starts, *window_hashes(b, starts)


def class_keys(text: bytes, positions: list[int]) -> list[tuple[int, int, int]]:
    """(hash, position, class) of the bytes that all strings of a class share, where the text holds such strings."""
    import xxhash
    out = []
    for p in positions:
        for j in range(SPREAD // CLASS):
            start = p - CLASS * j  # the shared bytes: from the last start of the class to the end of its first string
            if start >= 0 and start + CLASS_BYTES <= len(text):
                out.append((xxhash.xxh3_64_intdigest(text[start:start + CLASS_BYTES], j) - 2**63, p, j))
    return out


def _class_rows(batches):
    """(row, text, positions) -> (key, row, pos, cls)."""
    for batch in batches:
        for row, text, positions in zip(*(batch.column(c).to_pylist() for c in range(3))):
            for at in range(0, len(positions), 20_000):
                found = class_keys(text, positions[at:at + 20_000])
                keys, places, classes = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(np.full(len(keys), row, np.int64)),
                     pa.array(places, pa.int32()), pa.array(classes, pa.int32())], names=["key", "row", "pos", "cls"])


def _window_rows(batches):
    """(row, text, spots array<struct<pos, cls>>) -> (h1, h2, row, start) of the strings of these classes."""
    for batch in batches:
        for row, text, spots in zip(*(batch.column(c).to_pylist() for c in range(3))):
            b = np.frombuffer(text, np.uint8)
            last = np.array([s["pos"] - CLASS * s["cls"] for s in spots])
            starts = _covered_starts(len(b), np.maximum(last - CLASS + 1, 0), np.minimum(last, len(b) - LENGTH))
            for at in range(0, len(starts), 200_000):
                part = starts[at:at + 200_000]
                one, two = window_hashes(b, part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(np.full(len(part), row, np.int64)),
                     pa.array(part.astype(np.int32))], names=["h1", "h2", "row", "start"])


RUNS = "run long, part int, blob binary, idx int, row long, pos int"


def _pack(items: list[tuple[bytes, bytes, bool, int]]) -> bytes:
    """Sorted (right, reversed left, often, idx) -> one compressed, front-coded blob."""
    import zstandard
    shared, rest = front_code([x[0] for x in items])
    left_shared, left_rest = front_code([x[1] for x in items])
    numbers = np.array([shared, [len(x) for x in rest], left_shared, [len(x) for x in left_rest],
                        [x[2] for x in items], [x[3] for x in items]], np.int32)
    body = b"".join([np.int32(len(items)).tobytes(), numbers.tobytes(), *rest, *left_rest])
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(run: int, blob: bytes):
    """The stream of a run: (common prefix with the one before, (right, reversed left, often, run, idx))."""
    import zstandard
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.int32, 1)[0])
    shared, sizes, left_shared, left_sizes, often, idx = np.frombuffer(body, np.int32, 6 * n, 4).reshape(6, n).tolist()
    at = 4 + 24 * n
    left_at = at + sum(sizes)
    right = left = b""
    for k in range(n):
        right = right[:shared[k]] + body[at:at + sizes[k]]
        left = left[:left_shared[k]] + body[left_at:left_at + left_sizes[k]]
        at += sizes[k]
        left_at += left_sizes[k]
        yield shared[k], (right, left, often[k], run, idx[k])


def _sorted_runs(parts: int):
    """(row, text, positions) -> packed runs by range, and the anchors of each context."""
    import xxhash

    def flush(contexts, owners):
        run = int.from_bytes(np.random.default_rng().bytes(8), "little") >> 1
        names = sorted(contexts)
        often = [0] * len(names)
        rank = {}
        by_part: dict[int, list] = {}
        for k, (right, left) in enumerate(names):
            rank[contexts[right, left][0]] = k
            often[k] = int(contexts[right, left][1] > 1)
            part = xxhash.xxh3_64_intdigest(right[:LEAST_RIGHT]) % parts
            by_part.setdefault(part, []).append((right, left, often[k], k))
        for part, items in by_part.items():
            yield [run], [part], [_pack(items)], [None], [None], [None]
        n = len(owners)
        yield ([run] * n, [None] * n, [None] * n, [rank[o[0]] for o in owners],
               [o[1] for o in owners], [o[2] for o in owners])

    types = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int32()]
    names = [x.split()[0] for x in RUNS.split(", ")]

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches):
        contexts: dict[tuple[bytes, bytes], list[int]] = {}
        owners: list[tuple[int, int, int]] = []
        for batch in batches:
            for row, text, positions in zip(*(batch.column(c).to_pylist() for c in range(3))):
                back = text[::-1]
                for p in positions:
                    end = len(text) - p
                    name = text[p:p + LENGTH], back[end:end + LEFT]
                    entry = contexts.setdefault(name, [len(contexts), 0])
                    entry[1] += 1
                    owners.append((entry[0], row, p))
                if len(contexts) >= RUN_CONTEXTS or len(owners) >= 4 * RUN_CONTEXTS:
                    yield from map(batch_of, flush(contexts, owners))
                    contexts, owners = {}, []
        if contexts:
            yield from map(batch_of, flush(contexts, owners))
    return run


def merge_runs(runs: list):
    """Groups of neighbours in the merged order: (rights, items) with ``LEAST_RIGHT`` common bytes."""
    rights, items = [], []
    for shared, item in LoserTree(runs):
        if shared < LEAST_RIGHT and items:
            yield rights, items
            rights, items = [], []
        rights.append(shared)
        items.append(item)
    if items:
        yield rights, items


def _merge_ranges(batches):
    """(part, run, blob) sorted by part -> (run, idx, before, after) of matched contexts."""
    def matches(held):
        out = []
        for rights, items in merge_runs([_unpack(run, blob) for run, blob in held]):
            best = match_group(rights, [x[1] for x in items]) if len(items) > 1 else [(0, 0)]
            for (before, after), (right, left, often, run, idx) in zip(best, items):
                if often and len(left) + len(right) >= LENGTH:
                    before, after = len(left), len(right)
                if after:
                    out.append((run, idx, before, after))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
            names=["run", "idx", "before", "after"])

    held, now = [], None
    for batch in batches:
        for part, run, blob in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if part != now and held:
                yield matches(held)
                held = []
            now = part
            held.append((run, blob))
    if held:
        yield matches(held)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).select(
        "id", F.unhex(F.md5("text")).alias("mark"), "text")


def _same(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["mark"] == b["mark"])


def _crowded(counted: DataFrame, texts: DataFrame, crowd: int) -> DataFrame | None:
    """Candidate hashes with more than ``crowd`` different contexts; None without any."""
    many = stored(counted.filter(F.col("n") > crowd).select("key"), "suffix-many")
    if many.isEmpty():
        return None
    found = stored(texts.select("text").mapInArrow(_anchor_contexts, "key long, context long")
                   .join(many, "key", "left_semi").groupBy("key").agg(F.count_distinct("context").alias("n"))
                   .filter(F.col("n") > crowd).select("key", F.lit(True).alias("crowded")), "suffix-crowded")
    return None if found.isEmpty() else found


def _repeated_windows(docs: Texts, crowded: DataFrame) -> DataFrame:
    """(row, crowded) -> (row, start, end) of the 200-byte strings around crowded anchors that occur twice."""
    held = docs.rows.join(docs.dealt(crowded), "row").select("row", "text", "crowded")
    classes = stored(held.mapInArrow(_class_rows, "key long, row long, pos int, cls int"), "suffix-classes")
    alike = stored(classes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "suffix-alike")
    spots = (classes.join(alike, "key", "left_semi").groupBy("row")
             .agg(F.sort_array(F.collect_set(F.struct("pos", "cls"))).alias("spots")))
    around = stored(docs.rows.join(docs.dealt(spots), "row").select("row", "text", "spots")
                    .mapInArrow(_window_rows, "h1 long, h2 long, row long, start int"), "suffix-around")
    again = stored(around.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2"),
                   "suffix-windows")
    return (around.join(again, ["h1", "h2"], "left_semi")
            .select("row", "start", (F.col("start") + LENGTH).alias("end")))


class Texts(NamedTuple):
    """The documents' rows (row, id, mark, text), written once in buckets by ``row``."""
    rows: DataFrame
    buckets: int

    def dealt(self, side: DataFrame) -> DataFrame:
        """A narrow table with ``row``, dealt like the texts; joined on ``row``, it is hashed and no text moves."""
        return side.repartition(self.buckets, "row").hint("shuffle_hash")


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Texts:
    rows = _keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, -(-size // BUCKET_BYTES), min(cores, -(-size // SMALL_BUCKET_BYTES)))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "mark", "text")
    return Texts(stored_in_buckets(numbered, "suffix-rows", "row", buckets), buckets)


def repeated_spans(docs: DataFrame | Texts, id_col: str = "doc_id", text_col: str = "text",
                   crowd: int = CROWD) -> DataFrame:
    """(id, mark, n_bytes, sha256, spans array<struct<start, end>>, row) per row.

    ``mark`` tells texts of one id apart; ``row`` is the number in the stored texts.
    """
    docs = docs if isinstance(docs, Texts) else store_texts(docs, id_col, text_col)
    hashed = stored(docs.rows.select("row", "id", "mark", F.octet_length("text").alias("n_bytes"),
                                     F.sha2("text", 256).alias("sha256")), "suffix-texts")
    copied = stored(hashed.filter(F.col("n_bytes") >= LENGTH).groupBy("mark")
                    .agg(F.count("*").alias("n"), F.min("row").alias("rep")).filter("n > 1").select("mark", "rep"),
                    "suffix-copied")
    spare = stored(hashed.join(copied, "mark").filter(F.col("row") != F.col("rep")).select("row"), "suffix-spare")
    # the anchors are looked for up to three times, without shuffling the texts again
    texts = docs.rows.filter(F.octet_length("text") >= LENGTH).join(docs.dealt(spare), "row", "left_anti")

    spots = texts.select("row", "text").mapInArrow(_anchor_rows, "key long, row long, pos int")
    twice = stored(spots.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "suffix-keys")
    crowded = _crowded(twice, texts, crowd)
    if crowded is None:
        wanted = spots.join(twice, "key", "left_semi").withColumn("crowded", F.lit(False))
    else:
        keys = stored(twice.join(crowded, "key", "left")
                      .select("key", F.coalesce("crowded", F.lit(False)).alias("crowded")), "suffix-ways")
        wanted = spots.join(keys, "key")
    found = stored(
        wanted.select("row", F.when(~F.col("crowded"), F.col("pos")).alias("pos"),
                      F.when(F.col("crowded"), F.col("pos")).alias("crowded"))
        .groupBy("row").agg(F.sort_array(F.collect_set("pos")).alias("positions"),
                            F.sort_array(F.collect_set("crowded")).alias("crowded")), "suffix-anchors")
    n = found.agg(F.sum(F.size("positions"))).first()[0] or 0
    parts = max(1, n // RANGE_CONTEXTS)
    # no text moves, so the texts are read again rather than written with their positions
    held = docs.rows.join(docs.dealt(found.filter(F.size("positions") > 0).select("row", "positions")), "row")
    runs = stored(held.select("row", "text", "positions")
                  .mapInArrow(_sorted_runs(parts), RUNS), "suffix-runs")
    matched = stored(runs.filter("blob is not null").select("part", "run", "blob")
                     .repartition(parts, "part").sortWithinPartitions("part", "run")
                     .mapInArrow(_merge_ranges, "run long, idx int, before int, after int"), "suffix-matches")
    covered = (runs.filter("idx is not null").select("run", "idx", "row", "pos").join(matched, ["run", "idx"])
               .select("row", (F.col("pos") - F.col("before")).alias("start"),
                       (F.col("pos") + F.col("after")).alias("end")))
    if crowded is not None:
        around = found.filter(F.size("crowded") > 0).select("row", "crowded")
        covered = covered.union(_repeated_windows(docs, around))
    pieces = covered.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("pieces"))
    spans = stored(pieces.mapInArrow(_joined, SPANS), "suffix-spans")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = (hashed.join(copied.select("mark", F.lit(True).alias("copied")), "mark", "left")
           .join(spans, "row", "left"))  # what the search found for a copied text is not needed: it goes whole
    return out.select(F.col("id").alias(id_col), "mark", F.col("n_bytes").cast("long").alias("n_bytes"),
                      "sha256",
                      F.when(F.col("copied"), whole).otherwise(F.coalesce("spans", none)).alias("spans"), "row")


SPANS = "row long, spans array<struct<start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _joined(batches):
    """Sorted pieces of a document -> maximal spans."""
    for batch in batches:
        out = []
        for pieces in batch.column(1).to_pylist():
            spans: list[dict] = []
            for p in pieces:
                if spans and p["start"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], p["end"])
                else:
                    spans.append(dict(p))
            out.append(spans)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _SPAN)], names=["row", "spans"])


def cut_spans(docs: DataFrame | Texts, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, kept binary) of the documents that have spans: the bytes outside them, concatenated.

    Of stored texts the result has ``row`` in place of the id and mark, and no text moves.
    """
    hit = spans.filter(F.size("spans") > 0)
    if isinstance(docs, Texts):
        name = ["row"]
        both = docs.rows.select("row", "text").join(docs.dealt(hit.select("row", "spans")), "row")
    else:
        name = ["id", "mark"]
        rows = _keyed(docs, id_col, text_col)
        hit = hit.select(F.col(id_col).alias("id"), "mark", "spans").dropDuplicates(name)
        both = rows.join(hit, _same(rows, hit)).select(rows["id"], rows["mark"], "text", "spans")

    def cut(batches):
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                at, parts = 0, []
                for s in spans:
                    parts.append(text[at:s["start"]])
                    at = s["end"]
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in name), pa.array(kept, pa.binary())],
                                             names=[*name, "kept"])
    types = "row long" if name == ["row"] else "id long, mark binary"
    return both.mapInArrow(cut, f"{types}, kept binary").withColumnRenamed("id", id_col)
