"""Hard-negative mining by the threshold algorithm (Fagin, Lotem, Naor, PODS 2001) on integer vectors.

Each component x becomes floor(scale * x); a row's score for an anchor is the
integer inner product, computed exactly. An anchor's positives are its best
rows of the same label. Around each positive lies a window of scores, and the
best rows of other labels within it are the hard negatives.

Candidates are cut into blocks; a block holds one sorted list per dimension. An
anchor reads the list of dimension d from the top where its component is
positive and from the bottom where it is negative (sorted access); every row
met is scored in full (random access). The next unread entries bound the score
of all rows not met yet; an anchor leaves the block once that bound falls
strictly below the kth score (or, with fewer than k rows, the lower edge) of
every window it has. Anchors of a unit go through the lists together, in steps
of doubling depth, so the scores of a step are one matrix product; the windows
keep their kth scores from block to block.

Both searches run in units of (block of anchors, stripe of candidates), which a
task streams; per unit and window at most k rows come out, and a window
function merges them. No pairs are spelled out and no key's rows meet in a task.

Defined cases: a row with a null id, label or vector, or a null or non-finite
component takes no part, nor does one whose squared integer length does not fit
a long (no score could overflow otherwise). Vectors of different lengths are
never compared; empty vectors score 0 with each other. Equal rows are rows of
their own. Higher scores come first, then smaller ids. A positive with a
negative score has an empty window. No rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.storage import stored

SCALE = 256
ANCHOR_ROWS = 8192  # anchors of a unit
STRIPE_ROWS = 16384  # candidates of a unit
BLOCK_ROWS = 4096  # candidates whose lists are sorted together
CHUNK = 1024  # anchors scored in one matrix product
SALTS = 64  # tasks among which the rows of one key look up its size
PAIRS = 400_000  # scored pairs that are matched with windows at a time
EXACT = 2.0 ** 53

FOUND = "arow long, slot int, score long, id long, row long"
WINDOWS = "array<struct<slot:int,lo:long,hi:long>>"
LONG_MIN, LONG_MAX = -2**63, 2**63 - 1


class _Windows:
    """Score windows of the anchors of one unit, sorted by anchor, and the best rows found in each."""

    def __init__(self, anchor, lo, hi, k: int):
        self.anchor, self.lo, self.hi, self.k = anchor, lo, hi, k
        self.bar = lo.copy()  # a new row needs this score, and at this score a smaller id
        self.bar_id = np.full(len(lo), LONG_MAX)
        self.open = lo <= hi
        self.held = [np.zeros(0, np.int64)] * 4  # window, score, id, row

    def span(self, anchors: int):
        """Per anchor: first window, number of windows, lowest bar, highest edge."""
        n = np.bincount(self.anchor, minlength=anchors)
        low, high = np.full(anchors, LONG_MAX), np.full(anchors, LONG_MIN)
        np.minimum.at(low, self.anchor[self.open], self.bar[self.open])
        np.maximum.at(high, self.anchor[self.open], self.hi[self.open])
        return np.cumsum(n) - n, n, low, high

    def add(self, w, score, ids, rows) -> None:
        bar = self.bar[w]
        fits = self.open[w] & (score <= self.hi[w]) & (
            (score > bar) | (score == bar) & (ids <= self.bar_id[w]))
        parts = [np.concatenate([a, b[fits]]) for a, b in zip(self.held, (w, score, ids, rows))]
        order = np.lexsort((parts[3], parts[2], -parts[1], parts[0]))
        w = parts[0][order]
        first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, np.int64)
        place = np.arange(len(w)) - np.repeat(first, np.diff(np.r_[first, len(w)]))
        self.held = [p[order][place < self.k] for p in parts]
        full = np.flatnonzero(place == self.k - 1)
        self.bar[w[full]], self.bar_id[w[full]] = parts[1][order][full], parts[2][order][full] - 1


def _exact(a: np.ndarray, x: np.ndarray) -> bool:
    """Whether float products of these integers are exact."""
    if not a.size or not x.size:
        return True
    return float(np.abs(a).max()) * float(np.abs(x).max()) * a.shape[1] < EXACT


def _read_block(a, windows, x, ids, rows, allowed) -> int:
    """Threshold algorithm of all anchors ``a`` over one block; returns the rows scored, summed over anchors."""
    n, d = x.shape
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    kind = np.float64 if _exact(a, x) else np.int64
    af, xf = a.astype(kind), x.astype(kind)
    seen, depth, step, scored = np.zeros(n, bool), 0, 1, 0
    while depth < n and not seen.all():
        _, _, low, _ = windows.span(len(a))
        # the best score that a row not met yet can have (long products: sums stay below 2^63 row by row)
        bound = (up.astype(kind) @ lists[n - 1 - depth].astype(kind)
                 + down.astype(kind) @ lists[depth].astype(kind)) if d else np.zeros(len(a), kind)
        if kind is np.int64:  # lists mix rows, so the bound itself may leave a long: floats with a margin
            f = up.astype(float) @ lists[n - 1 - depth].astype(float) + down.astype(float) @ lists[depth].astype(float)
            bound = f + np.abs(f) * 1e-9 + 1.0
        active = np.flatnonzero(~(bound < low.astype(bound.dtype)) & (low != LONG_MAX))
        if not len(active):
            break
        stop = min(depth + step, n)
        met = [order[n - stop:n - depth][:, (a[active] > 0).any(axis=0)].ravel(),
               order[depth:stop][:, (a[active] < 0).any(axis=0)].ravel()]
        fresh = np.zeros(n, bool)
        fresh[np.concatenate(met)] = True
        fresh &= ~seen
        if not (a[active] != 0).any(axis=1).all():  # a zero anchor has no list to read: every row scores 0
            fresh = ~seen
        new = np.flatnonzero(fresh)
        seen |= fresh
        depth, step = stop, step * 2
        for at in range(0, len(active), CHUNK):
            part = active[at:at + CHUNK]
            scores = af[part] @ xf[new].T
            scored += scores.size
            start, count, low, high = windows.span(len(a))
            hit = (scores >= low[part].astype(kind)[:, None]) & (scores <= high[part].astype(kind)[:, None])
            pieces = np.cumsum(hit.sum(axis=1)) // PAIRS  # whole anchors, about PAIRS pairs each
            for piece in np.unique(pieces):
                own = np.flatnonzero(pieces == piece)
                i, j = np.nonzero(hit[own])
                s, i, j = scores[own][i, j].astype(np.int64), part[own][i], new[j]
                ok = allowed(i, j)
                s, i, j = s[ok], i[ok], j[ok]
                each = count[i]
                w = np.repeat(start[i], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                s, j = np.repeat(s, each), np.repeat(j, each)
                windows.add(w, s, ids[j], rows[j])
    return scored


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _blocks(batches, n_keys: int):
    """Sorted batches -> (unit number, table) pieces of one unit and kind; candidates in pieces of BLOCK_ROWS."""
    held, key, unit, size = [], None, -1, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(n_keys + 1)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            now = tuple(keys[start].tolist())
            if now != key:
                if held:
                    yield unit, pa.Table.from_batches(held)
                held, size = [], 0
                if key is None or now[:-1] != key[:-1]:
                    unit += 1
                key = now
            while start < stop:
                # anchors of a unit stay together, their number is bounded
                room = stop - start if now[-1] == 0 else min(stop - start, BLOCK_ROWS - size)
                held.append(batch.slice(start, room))
                start, size = start + room, size + room
                if now[-1] == 1 and size == BLOCK_ROWS:
                    yield unit, pa.Table.from_batches(held)
                    held, size = [], 0
    if held:
        yield unit, pa.Table.from_batches(held)


def _search(n_keys: int, k: int, same_label: bool):
    """Units of anchors and candidate blocks -> per window the best k rows of the unit."""
    def run(batches):
        unit, a, windows = None, None, None

        def found():
            if windows is None or not len(windows.held[0]):
                return
            w, score, ids, rows = windows.held
            yield pa.RecordBatch.from_arrays(
                [pa.array(arow[windows.anchor[w]]), pa.array(slots[w].astype(np.int32)), pa.array(score),
                 pa.array(ids), pa.array(rows)], names=["arow", "slot", "score", "id", "row"])
        for number, table in _blocks(batches, n_keys):
            ids, rows = table.column("id").to_numpy(), table.column("row").to_numpy()
            labels, dim = table.column("label").to_numpy(), table.column("dim")[0].as_py()
            x = _matrix(table.column("q"), dim)
            if table.column("kind")[0].as_py() == 0:
                yield from found()
                unit, a, arow, alabel = number, x, rows, labels
                wins = table.column("windows").combine_chunks()
                parts = wins.flatten()
                windows = _Windows(np.repeat(np.arange(len(a)), wins.value_lengths().to_numpy(zero_copy_only=False)),
                                   parts.field("lo").to_numpy().copy(), parts.field("hi").to_numpy().copy(), k)
                slots = parts.field("slot").to_numpy()
            elif number == unit:
                def allowed(i, j):
                    same = alabel[i] == labels[j]
                    return same & (arow[i] != rows[j]) if same_label else ~same
                _read_block(a, windows, x, ids, rows, allowed)
        yield from found()
    return run


def _units(anchors: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Anchors (with ``windows``) and candidates of equal ``key``, dealt to units and sorted for streaming."""
    counts = (rows.groupBy(*key).agg(F.count("*").alias("n")).join(
        anchors.groupBy(*key).agg(F.count("*").alias("m")), key)
        .select(*key, F.ceil(F.col("n") / STRIPE_ROWS).cast("int").alias("stripes"),
                F.ceil(F.col("m") / ANCHOR_ROWS).cast("int").alias("groups"),
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))

    def dealt(df, own, own_n, other, other_n, kind, windows):
        return (df.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(counts, [*key, "salt"])
                .withColumn(own, F.pmod(F.xxhash64("row"), F.col(own_n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
                .select(*[F.col(c).alias(f"k_{c}") for c in key], F.col("a").alias("k_a"), F.col("s").alias("k_s"),
                        F.lit(kind).alias("kind"), "row", "id", "label", "dim", "q", windows.alias("windows")))
    both = dealt(anchors, "a", "groups", "s", "stripes", 0, F.col("windows")).unionByName(
        dealt(rows, "s", "stripes", "a", "groups", 1, F.lit(None).cast(WINDOWS)))
    names = [f"k_{c}" for c in key] + ["k_a", "k_s"]
    return both.repartition(*names).sortWithinPartitions(*names, "kind")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("arow", "slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(row, id, label, dim, q) of the rows that take part; ``row`` tells equal rows apart."""
    wide = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v")).filter(
        "id is not null and label is not null and v is not null").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    scaled = wide.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))
    # well below 2^63, so that the rounding of the double cannot matter
    fits = scaled.filter(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < F.lit(9.2e18))
    return fits.select(F.monotonically_increasing_id().alias("row"), "id", "label",
                       F.size("v").alias("dim"), F.transform("v", lambda x: x.cast("long")).alias("q"))


def mine_hard_negatives(vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10,
                        low: int = 30, high: int = 90, scale: int = SCALE, id_col: str = "vec_id",
                        vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``anchor_every``. A negative's score lies within
    ``low`` to ``high`` percent of the positive's. A stored row keeps its number, so reruns of a task agree.
    """
    rows = stored(integer_rows(vectors, id_col, vector_col, label_col, scale), "integer-rows")
    anchors = rows.filter(F.col("id") % anchor_every == 0)
    whole = anchors.withColumn("windows", F.array(F.struct(
        F.lit(0).alias("slot"), F.lit(LONG_MIN).alias("lo"), F.lit(LONG_MAX).alias("hi"))).cast(WINDOWS))
    found = _units(whole, rows, ["label", "dim"]).mapInArrow(_search(4, positives, True), FOUND)
    best = stored(_best(found, positives), "positives")

    def part(percent: int, up: int):  # 100 n >= low p, 100 n <= high p, in longs
        return F.expr(f"(cast(score as decimal(20,0)) * {percent} + {up}) div 100")
    edges = best.filter("score >= 0").groupBy("arow").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").alias("slot"), part(low, 99).alias("lo"), part(high, 0).alias("hi")))).cast(WINDOWS).alias("windows"))
    around = anchors.join(edges, F.col("row") == F.col("arow")).drop("arow")
    found = _best(_units(around, rows, ["dim"]).mapInArrow(_search(3, negatives, False), FOUND), negatives)
    return (found.select("arow", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(best.select("arow", F.col("rank").alias("slot"), F.col("id").alias("positive_id"),
                              F.col("score").alias("positive_score")), ["arow", "slot"])
            .join(anchors.select(F.col("row").alias("arow"), F.col("id").alias("anchor_id")), "arow")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
