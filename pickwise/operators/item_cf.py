"""Item-based collaborative filtering by co-occurrence.

sim(p1, p2) = n12 / sqrt(n1 * n2), where n1, n2 count the ratings of each
product and n12 counts pairs of ratings by one user of p1 and p2. Repeat
ratings are not deduplicated: a user who rated p1 twice and p2 three times adds
6 to n12, exactly as a self-join of the raw rating rows would.

Plan:
1. Pre-aggregate ratings to (user, product, m = multiplicity), with map-side
   partial aggregation; the result is written once and read by every branch.
2. Light users (at most T distinct products) contribute their product pairs
   through a self-join on user, each unordered pair once (p1 < p2). A light
   user emits at most T^2 / 2 pairs.
3. Heavy users (more than T products) never form pairs. Their products are cut
   into blocks of about ``_BLOCK_PRODUCTS`` and the users into blocks of their
   own; a unit of work is (user block, product block, product block). It streams
   its rows user by user into one dense product X_I^T X_J and emits a row per
   co-rated pair: one for all users of the block instead of one per user. A
   rating goes only to the units its user needs: once per product block that
   the user touches.
4. ``item_similarity``: the counts of both paths are summed in one aggregation
   with map-side combine, scored, and mirrored with a two-row explode. T moves
   work between the paths only.
5. ``item_cf_recs`` never shuffles pairs of light users: products are cut into
   parts, every user's list goes to the parts it touches, and a part counts its
   pairs and keeps the best k of each product before a window ranks them. Many
   lists are sent to one group of parts after the other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise import schemas
from pickwise.functions.columns import cooccurrence_sim
from pickwise.operators.topk import top_k
from pickwise.session import materialize, shuffles_released

HEAVY_USER_PRODUCTS = 2000
_BLOCK_PRODUCTS = 2048  # a unit holds counts of about 2048 x 2048 products, 32 MB
_UNIT_ROWS = 4 << 20  # heavy rating rows aimed at in a unit
_PART_ENTRIES = 32 << 20  # entries of users' lists aimed at in a part of the products, about 400 MB
_GROUP_ENTRIES = 1 << 29  # entries sent to a group of parts before the next group starts, about 2 GB of shuffle
_ROUND_PAIRS = 6 << 20  # ordered pairs of products counted at a time in a part, about 200 MB


def user_product_counts(ratings: DataFrame, dedupe: bool = False) -> DataFrame:
    """(user_id, product_id, m): how often each user rated each product; with ``dedupe``, once."""
    if dedupe:
        return ratings.select("user_id", "product_id").distinct().withColumn("m", F.lit(1).cast("long"))
    return ratings.groupBy("user_id", "product_id").agg(F.count("*").alias("m"))


def _prepare(ratings: DataFrame, heavy_user_products: int, dedupe: bool = False) -> tuple[DataFrame, bool]:
    """(user_id, product_id, m, n, hu) and whether any heavy user exists.

    m is the multiplicity, n the product's rating count, hu flags heavy users.
    """
    um = materialize(user_product_counts(ratings, dedupe), "user-product")
    n = um.groupBy("product_id").agg(F.sum("m").alias("n"))
    deg = um.groupBy("user_id").agg(F.count("*").alias("d"))
    heavy_users = deg.filter(F.col("d") > heavy_user_products).select("user_id")
    with_n = um.join(n, "product_id")
    if heavy_users.limit(1).count() == 0:  # the usual case: no flag join
        return with_n.select("user_id", "product_id", "m", "n", F.lit(False).alias("hu")), False
    rows = (with_n.join(heavy_users.withColumn("hu", F.lit(True)), "user_id", "left")
            .select("user_id", "product_id", "m", "n", F.coalesce("hu", F.lit(False)).alias("hu")))
    return materialize(rows, "user-product-flags"), True


def pair_rows(ratings: DataFrame, heavy_user_products: int = HEAVY_USER_PRODUCTS) -> int:
    """Rows that the light users' self-join sends to the pair aggregation, before map-side combine."""
    d = F.col("d")
    deg = ratings.groupBy("user_id").agg(F.countDistinct("product_id").alias("d"))
    return int(deg.filter(d <= heavy_user_products)
               .agg(F.sum((d.cast("double") * (d - 1)) / 2)).first()[0] or 0)


def _light_rows(rows: DataFrame) -> DataFrame:
    """(p1, p2, c, n1, n2) per light user and pair of products, p1 < p2."""
    light = rows.filter(~F.col("hu"))
    left = light.select("user_id", F.col("product_id").alias("p1"), F.col("m").alias("m1"), F.col("n").alias("n1"))
    right = light.select("user_id", F.col("product_id").alias("p2"), F.col("m").alias("m2"), F.col("n").alias("n2"))
    pairs = left.join(right, "user_id").where(F.col("p1") < F.col("p2"))
    return pairs.select("p1", "p2", (F.col("m1") * F.col("m2")).alias("c"), "n1", "n2")


def _unit_pairs(pair_schema: pa.Schema, chunk_rows: int = 1 << 18, chunk_users: int = 1024):
    """Rows (u, bi, bj, user, block, slot, product, m, n) sorted by unit and user -> (p1, p2, c, n1, n2).

    Memory is bounded by the counts of a unit and one chunk of users. Everything
    the function uses is defined inside it, so it is shipped to the Python
    workers by value and needs no import of this package there.
    """
    class Side:
        """Products of one block by slot, in arrays that grow with the slots seen."""

        def __init__(self):
            self.ids = np.zeros(0, np.int64)
            self.n = np.zeros(0, np.int64)

        def add(self, slots, ids, n):
            room = int(slots.max()) + 1 - len(self.ids)
            if room > 0:
                self.ids = np.concatenate((self.ids, np.zeros(room, np.int64)))
                self.n = np.concatenate((self.n, np.zeros(room, np.int64)))
            self.ids[slots], self.n[slots] = ids, n

    class Unit:
        def __init__(self, key):
            self.same = key[1] == key[2]
            self.blocks = key[1], key[2]
            self.sides = Side(), Side()
            self.counts = np.zeros((0, 0))
            self.held: list = []
            self.n_held = 0

        def add(self, columns):
            self.held.append(columns)
            self.n_held += len(columns[0])
            if self.n_held >= chunk_rows:
                self.work(last=False)

        def work(self, last):
            """Counts the held users; without ``last`` the final user may go on and is kept."""
            user, block, slot, ids, m, n = (np.concatenate(c) for c in zip(*self.held))
            stop = len(user) if last else int(np.searchsorted(user, user[-1]))
            rest = [c[stop:] for c in (user, block, slot, ids, m, n)]
            self.held, self.n_held = [rest], len(rest[0])
            if not stop:
                return
            user, block, slot, ids, m, n = (c[:stop] for c in (user, block, slot, ids, m, n))
            _, who = np.unique(user, return_inverse=True)
            first = block == self.blocks[0]
            for side, mine in zip(self.sides, (first, ~first)):
                if mine.any():
                    side.add(slot[mine], ids[mine], n[mine])
            rows, cols = len(self.sides[0].ids), len(self.sides[0 if self.same else 1].ids)
            grown = np.zeros((rows, cols))
            grown[:self.counts.shape[0], :self.counts.shape[1]] = self.counts
            self.counts = grown
            for start in range(0, int(who[-1]) + 1, chunk_users):
                lo, hi = np.searchsorted(who, (start, start + chunk_users))
                w, f = who[lo:hi] - start, first[lo:hi]
                x = np.zeros((chunk_users, rows))
                x[w[f], slot[lo:hi][f]] = m[lo:hi][f]
                y = x
                if not self.same:
                    y = np.zeros((chunk_users, cols))
                    y[w[~f], slot[lo:hi][~f]] = m[lo:hi][~f]
                self.counts += x.T @ y

        def pairs(self):
            self.work(last=True)
            a, b = self.sides[0], self.sides[0 if self.same else 1]
            for i in range(0, len(a.ids), 64):
                x, y = np.nonzero(self.counts[i:i + 64])
                c = self.counts[i:i + 64][x, y]
                x = x + i
                if self.same:
                    once = a.ids[x] < b.ids[y]
                    x, y, c = x[once], y[once], c[once]
                if len(x):
                    swap = a.ids[x] > b.ids[y]
                    out = (np.where(swap, b.ids[y], a.ids[x]), np.where(swap, a.ids[x], b.ids[y]), c.astype(np.int64),
                           np.where(swap, b.n[y], a.n[x]), np.where(swap, a.n[x], b.n[y]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v).cast(t.type) for v, t in zip(out, pair_schema)], schema=pair_schema)

    def run(batches):
        unit, key = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = np.stack(columns[:3], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts, cuts[1:]):
                if unit is None or tuple(keys[start]) != key:
                    if unit is not None:
                        yield from unit.pairs()
                    key = tuple(keys[start])
                    unit = Unit(key)
                unit.add([c[start:stop] for c in columns[3:]])
        if unit is not None:
            yield from unit.pairs()
    return run


def _heavy_units(rows: DataFrame, block_products: int = _BLOCK_PRODUCTS, unit_rows: int = _UNIT_ROWS) -> DataFrame:
    """Rows (u, bi, bj, user, block, slot, product, m, n) of heavy users, one per unit that needs them.

    A user's rating goes to the pairs of its own block with the blocks that the
    same user touches, at most as many as the user has products; in any other
    unit it would meet nothing.
    """
    heavy = rows.filter("hu")
    stats = heavy.agg(F.countDistinct("product_id").alias("p"), F.count("*").alias("rows")).first()
    nb = max(1, math.ceil(stats["p"] / block_products))
    nu = max(1, math.ceil(2 * stats["rows"] / (nb * unit_rows)))
    slot = Window.partitionBy("block").orderBy("product_id")  # about block_products rows each
    products = (heavy.select("product_id").distinct()
                .withColumn("block", F.pmod(F.xxhash64("product_id"), F.lit(nb)))
                .withColumn("slot", F.row_number().over(slot) - 1))
    placed = heavy.join(products, "product_id")
    touched = placed.groupBy("user_id").agg(F.collect_set("block").alias("blocks"))  # at most one entry a block
    return (placed.join(touched, "user_id").withColumn("other", F.explode("blocks"))
            .select(F.pmod(F.xxhash64("user_id"), F.lit(nu)).alias("u"),
                    F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                    F.col("user_id").cast("long"), "block", "slot", F.col("product_id").cast("long"), "m", "n"))


def _heavy_rows(rows: DataFrame, block_products: int = _BLOCK_PRODUCTS, unit_rows: int = _UNIT_ROWS) -> DataFrame:
    """(p1, p2, c, n1, n2) per block of heavy users and pair of their products, p1 < p2."""
    spread = _heavy_units(rows, block_products, unit_rows)
    kind = rows.schema["product_id"].dataType.simpleString()
    schema = f"p1 {kind}, p2 {kind}, c long, n1 long, n2 long"
    ids = pa.int32() if kind == "int" else pa.int64()
    arrow = pa.schema([("p1", ids), ("p2", ids), ("c", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64())])
    return (spread.repartition("u", "bi", "bj").sortWithinPartitions("u", "bi", "bj", "user_id")
            .mapInArrow(_unit_pairs(arrow), schema))


def _counted(pairs: DataFrame) -> DataFrame:
    """Sums (p1, p2, c, n1, n2) to (p1, p2, n12, n1, n2); n1 and n2 are constant per pair."""
    return pairs.groupBy("p1", "p2").agg(F.sum("c").alias("n12"), F.max("n1").alias("n1"), F.max("n2").alias("n2"))


def _mirror_scored(co: DataFrame) -> DataFrame:
    sim = cooccurrence_sim("n12", "n1", "n2")
    both = F.explode(F.array(
        F.struct(F.col("p1").alias("product_id"), F.col("p2").alias("rec_product_id")),
        F.struct(F.col("p2").alias("product_id"), F.col("p1").alias("rec_product_id"))))
    return co.select(both.alias("e"), sim.alias("score")).select("e.*", "score")


def item_similarity(ratings: DataFrame, threshold: float | None = None,
                    heavy_user_products: int = HEAVY_USER_PRODUCTS, dedupe: bool = False) -> DataFrame:
    """Long-form co-occurrence similarity of co-rated pairs, both directions, self-pairs excluded.

    With ``threshold``, only pairs with similarity > threshold are returned. A
    product rated repeatedly by one user counts repeatedly, so the similarity may
    exceed 1; with ``dedupe`` it counts once.
    """
    rows, has_heavy = _prepare(ratings, heavy_user_products, dedupe)
    pairs = _light_rows(rows)
    scored = _mirror_scored(_counted(pairs.union(_heavy_rows(rows)) if has_heavy else pairs))
    return scored if threshold is None else scored.filter(F.col("score") > float(threshold))


def _baskets(rows: DataFrame, has_heavy: bool) -> DataFrame:
    """(p, m, n): arrays whose every two entries are co-rated m1 * m2 times: light users, and single pairs of heavy ones."""
    light = (rows.filter(~F.col("hu") & F.col("user_id").isNotNull()).groupBy("user_id")
             .agg(F.collect_list(F.struct("product_id", "m", "n")).alias("e"))
             .select(F.col("e.product_id").alias("p"), F.col("e.m").alias("m"), F.col("e.n").alias("n")))
    if not has_heavy:
        return light
    one = F.lit(1).cast("long")
    return light.union(_heavy_rows(rows.filter(F.col("user_id").isNotNull())).select(
        F.array("p1", "p2"), F.array("c", one), F.array("n1", "n2")))


def _parts(rows: DataFrame, part_entries: int) -> tuple[int, str, str]:
    """The parts and types of :func:`_dealt`."""
    return _dealt(rows, part_entries)[:3]


def _dealt(rows: DataFrame, part_entries: int) -> tuple[int, str, str, float]:
    """Parts of the products, a prime: one for each core, and more where a part would get over ``part_entries`` entries.

    Every part more is a copy more of most users' lists, so the number is found in steps of a quarter. With it come
    the smallest types that hold every m and every n of the lists, and about how many entries all parts get.
    """
    d = F.col("d").cast("double")
    users = rows.filter("user_id is not null").groupBy("user_id").agg(F.count("*").alias("d"), F.first("hu").alias("hu"),
                                                                        F.max("m").alias("m"), F.max("n").alias("n"))
    sizes = sorted({math.ceil(1.25 ** i) for i in range(3, 76)})
    # a user's d entries go to a part with the chance that it holds one of them
    light, heavy = F.col("hu") == F.lit(False), F.col("hu")
    found = users.agg(F.sum(F.when(heavy, d * (d - 1))).alias("heavy"),
                      *[F.sum(F.when(light, d * (1 - F.pow(F.lit(1 - 1 / s), d)))).alias(f"s{s}") for s in sizes],
                      F.max("m").alias("m"), F.max("n").alias("n")).first()
    pairs = found["heavy"] or 0.0
    if pairs:  # heavy users' pairs are counted before they are sent
        pairs = min(pairs, float(rows.filter("hu").select("product_id").distinct().count()) ** 2)
    need = next((s for s in sizes if (found[f"s{s}"] or 0.0) + 2 * pairs / s <= part_entries), sizes[-1])
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, need)
    while any(parts % f == 0 for f in range(2, math.isqrt(parts) + 1)):
        parts += 1
    m, n = (next(kind for kind, bits in (("byte", 7), ("short", 15), ("int", 31), ("long", 63)) if (found[x] or 0) < 2 ** bits)
            for x in ("m", "n"))
    sent = parts * (found[f"s{next((s for s in sizes if s >= parts), sizes[-1])}"] or 0.0) + 2 * pairs
    return parts, "long" if pairs else m, n, sent  # m of heavy users' pairs are sums


def _part_best(parts: int, k: int, schema: pa.Schema, round_pairs: int):
    """Rows (part, p, m, n) of one part -> (product_id, rec_product_id, score), the best k of each of its products.

    A task holds its lists and takes its products in rounds of about
    ``round_pairs`` pairs; in a round, pairs are summed whenever as many wait as
    were summed before, so memory follows the round's distinct pairs.
    """
    chunk = max(1, round_pairs // 4)

    def small(x):
        if x.dtype.itemsize <= 4:
            return x
        return x.astype(np.int32) if len(x) and x.min() >= -2**31 and x.max() < 2**31 else x.astype(np.int64)

    def summed(a, b, c, nn):
        narrow = min(a.min(), b.min()) >= -2**31 and max(a.max(), b.max()) < 2**31
        order = np.argsort((a << 32) + (b + 2**31)) if narrow else np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        return a[first], b[first], np.add.reduceat(c[order], first), nn[order][first]

    def outer(p, m, n, start, size, left, row):
        """The entries ``left`` with the others of their lists, a bounded number of pairs at a time."""
        each = size[row].astype(np.int64)
        end = np.cumsum(each)
        at = 0
        while at < len(left):
            to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + chunk, side="right")))
            e = each[at:to]
            x = np.repeat(left[at:to], e)
            y = np.repeat(start[row[at:to]], e) + np.arange(e.sum()) - np.repeat(np.cumsum(e) - e, e)
            other = p[x] != p[y]
            x, y = x[other], y[other]
            yield (p[x].astype(np.int64), p[y].astype(np.int64), m[x].astype(np.int64) * m[y],
                   n[x].astype(np.float64) * n[y].astype(np.float64))
            at = to

    def best(found):
        held, waiting, done = [], 0, 0
        for pairs in found:
            held.append(pairs)
            waiting += len(pairs[0])
            if waiting >= max(2 * chunk, done):
                held = [summed(*(np.concatenate(c) for c in zip(*held)))]
                waiting, done = 0, len(held[0][0])
        if not sum(len(h[0]) for h in held):
            return
        a, b, c, nn = summed(*(np.concatenate(c) for c in zip(*held)))
        score = c.astype(np.float64) / np.sqrt(nn)
        order = np.lexsort((b, -score, a))
        a, b, score = a[order], b[order], score[order]
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
        keep = np.flatnonzero(place < k)
        for at in range(0, len(keep), 1 << 16):
            take = keep[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[take]).cast(t.type) for v, t in zip((a, b, score), schema)], schema=schema)

    def run(batches):
        part, held = None, []
        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                held.append([small(np.diff(batch.column(1).offsets.to_numpy())),
                             *(small(batch.column(c).flatten().to_numpy(zero_copy_only=False)) for c in (1, 2, 3))])
        if part is None:
            return
        columns = list(zip(*held))
        held = None
        for i, c in enumerate(columns):  # one column at a time is there twice
            columns[i] = np.concatenate(c)
        size, p, m, n = columns
        start = np.cumsum(size, dtype=np.int64) - size
        left = np.flatnonzero(p % parts == part)
        row = np.searchsorted(start, left, side="right") - 1
        rounds = max(1, -(-int(size[row].sum(dtype=np.int64)) // round_pairs))
        turn = (p[left] // parts) % rounds
        for r in range(rounds):
            now = turn == r
            yield from best(outer(p, m, n, start, size, left[now], row[now]))
    return run


def item_cf_recs(ratings: DataFrame, k: int = schemas.ITEM_CF_MAX_RECOMMENDATION,
                 heavy_user_products: int = HEAVY_USER_PRODUCTS, dedupe: bool = False,
                 part_entries: int = _PART_ENTRIES, round_pairs: int = _ROUND_PAIRS,
                 group_entries: int = _GROUP_ENTRIES) -> DataFrame:
    """Top-k co-rated products per product: (product_id, rec_product_id, score, rank).

    The products are cut into parts. A user's list goes once to every part it
    touches, where all pairs of the part's products are counted and ranked: what
    travels are lists and k rows a product, never pairs. Where the lists sent come
    to more than ``group_entries``, they are written once and the parts work in
    groups, one after the other, so that the disks hold the lists of one group.
    """
    spark = ratings.sparkSession
    with shuffles_released(spark):
        rows, has_heavy = _prepare(ratings, heavy_user_products, dedupe)
        parts, m, n, entries = _dealt(rows, part_entries)
        groups = min(math.ceil(entries / group_entries), parts // spark.sparkContext.defaultParallelism)
        lists = _baskets(rows, has_heavy).select("p", F.col("m").cast(f"array<{m}>").alias("m"), F.col("n").cast(f"array<{n}>").alias("n"))
        kind = rows.schema["product_id"].dataType.simpleString()
        ids = pa.int32() if kind == "int" else pa.int64()
        arrow = pa.schema([("product_id", ids), ("rec_product_id", ids), ("score", pa.float64())])
        part = F.array_distinct(F.transform("p", lambda x: F.pmod(x, F.lit(parts)).cast("int")))

        def counted(lists: DataFrame, part: F.Column, groups: int) -> DataFrame:
            sent = lists.select(F.explode(part).alias("part"), "p", "m", "n")
            return sent.repartitionById(-(-parts // groups), F.expr(f"part div {groups}").cast("int")).mapInArrow(
                _part_best(parts, k, arrow, round_pairs), f"product_id {kind}, rec_product_id {kind}, score double")
        if groups > 1:
            lists = materialize(lists, "user-lists")
            best = None
            for group in range(groups):
                mine = F.filter(part, lambda x: F.pmod(x, F.lit(groups)) == group)
                found = materialize(counted(lists, mine, groups), "part-best")
                best = found if best is None else best.unionByName(found)
        else:
            best = counted(lists, part, 1)
    return top_k(best, ["product_id"], [F.desc("score"), F.asc("rec_product_id")], k)
