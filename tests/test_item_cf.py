import math
from collections import Counter, defaultdict
from itertools import product

from pickwise import schemas
from pickwise.operators import item_cf


def _ratings(spark, pairs):
    return spark.createDataFrame([(u, p, 3.0, 0) for u, p in pairs], schemas.RATING)


def _sims(df):
    return {(r.product_id, r.rec_product_id): r.score for r in df.collect()}


def test_hand_worked_cooccurrence(spark):
    r = _ratings(spark, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)])
    s = _sims(item_cf.item_similarity(r))
    assert set(s) == {(1, 2), (2, 1)}
    assert math.isclose(s[(1, 2)], 2 / math.sqrt(6)) and s[(1, 2)] == s[(2, 1)]


def test_duplicate_rating_is_not_deduplicated(spark):
    r = _ratings(spark, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (1, 2)])
    s = _sims(item_cf.item_similarity(r))
    assert math.isclose(s[(1, 2)], 1.0)


def _brute(pairs, k):
    by_user = defaultdict(list)
    for u, p in pairs:
        by_user[u].append(p)
    n = Counter(p for _, p in pairs)
    n12 = Counter()
    for ps in by_user.values():
        for a, b in product(ps, ps):
            if a != b:
                n12[(a, b)] += 1
    out = defaultdict(list)
    for (a, b), c in n12.items():
        out[a].append((-(c / math.sqrt(n[a] * n[b])), b))
    return {a: [b for _, b in sorted(v)[:k]] for a, v in out.items()}


def test_matches_brute_force_with_and_without_heavy_user_split(spark):
    import random
    rnd = random.Random(3)
    pairs = [(rnd.randrange(6), rnd.randrange(25)) for _ in range(300)]
    pairs += [(99, p) for p in range(25)] * 2  # one heavy user with repeats
    r = _ratings(spark, pairs)
    want = _brute(pairs, 4)
    for heavy in (2000, 3):
        got = item_cf.item_cf_recs(r, k=4, heavy_user_products=heavy).collect()
        by = defaultdict(list)
        for row in sorted(got, key=lambda x: (x.product_id, x.rank)):
            by[row.product_id].append(row.rec_product_id)
        assert dict(by) == want, heavy


def test_negative_and_extreme_ids(spark):
    big, neg = 2_147_483_647, -2_147_483_648
    r = _ratings(spark, [(1, big), (1, neg), (1, -5), (2, big), (2, -5)])
    s = _sims(item_cf.item_similarity(r))
    assert set(s) == {(big, neg), (neg, big), (big, -5), (-5, big), (neg, -5), (-5, neg)}
    assert math.isclose(s[(big, -5)], 2 / math.sqrt(4))
    assert math.isclose(s[(neg, -5)], 1 / math.sqrt(2))


def test_hot_user_with_a_third_of_all_rows(spark):
    import random
    rnd = random.Random(7)
    pairs = [(u, rnd.randrange(120)) for u in range(1, 60) for _ in range(rnd.randrange(1, 6))]
    hot = [(0, p) for p in range(120)] + [(0, p) for p in range(0, 120, 3)]  # repeats too
    pairs += hot
    assert len(hot) * 3 >= len(pairs) * 0.9
    r = _ratings(spark, pairs)
    want = _brute(pairs, 10)
    got = item_cf.item_cf_recs(r, k=10, heavy_user_products=50).collect()
    by = defaultdict(list)
    for row in sorted(got, key=lambda x: (x.product_id, x.rank)):
        by[row.product_id].append(row.rec_product_id)
    assert dict(by) == want


def test_thresholded_similarity_with_heavy_users_equals_full_table(spark):
    import random
    rnd = random.Random(11)
    pairs = [(u, rnd.randrange(40)) for u in range(1, 80) for _ in range(rnd.randrange(1, 5))]
    pairs += [(0, p) for p in range(0, 40, 2)] + [(90, p) for p in range(25)]
    r = _ratings(spark, pairs)
    full = {k: v for k, v in _sims(item_cf.item_similarity(r)).items() if v > 0.3}
    for heavy in (2000, 10):
        got = _sims(item_cf.item_similarity(r, threshold=0.3, heavy_user_products=heavy))
        assert got.keys() == full.keys(), heavy
        assert all(math.isclose(got[k], full[k]) for k in full)


def test_heavy_counts_over_many_blocks_and_chunks(spark):
    import random

    import pyarrow as pa
    rnd = random.Random(5)
    pairs = [(u, p) for u in range(30) for p in rnd.sample(range(-20, 60), 25)] + [(3, 1), (3, 2)]
    rows, has_heavy = item_cf._prepare(_ratings(spark, pairs), 4)
    assert has_heavy
    n, n12 = Counter(p for _, p in pairs), Counter()
    by_user = defaultdict(list)
    for u, p in pairs:
        by_user[u].append(p)
    for ps in by_user.values():
        n12.update((a, b) for a, b in product(ps, ps) if a < b)
    want = {(a, b): (c, n[a], n[b]) for (a, b), c in n12.items()}
    got = item_cf._counted(item_cf._heavy_rows(rows, block_products=9, unit_rows=40)).collect()
    assert {(r.p1, r.p2): (r.n12, r.n1, r.n2) for r in got} == want
    # a unit whose users come in several chunks, its matrix growing with the slots
    schema = pa.schema([(c, pa.int64()) for c in ("p1", "p2", "c", "n1", "n2")])
    flat = sorted((0, 0, 0, u, 0, p + 20, p, m, n[p]) for (u, p), m in Counter(pairs).items())
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat[i:i + 37])], names=list("abcdefghi"))
               for i in range(0, len(flat), 37)]
    out = [r for b in item_cf._unit_pairs(schema, chunk_rows=50, chunk_users=2)(iter(batches)) for r in b.to_pylist()]
    assert {(r["p1"], r["p2"]): (r["c"], r["n1"], r["n2"]) for r in out} == want


def test_dedupe_counts_a_rating_once(spark):
    pairs = [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (1, 2), (1, 2), (4, 7), (4, 7)]
    once = sorted(set(pairs))
    for heavy in (2000, 1):
        got = _sims(item_cf.item_similarity(_ratings(spark, pairs), heavy_user_products=heavy, dedupe=True))
        assert got == _sims(item_cf.item_similarity(_ratings(spark, once))) and got[1, 2] == 2 / math.sqrt(6)


def test_a_heavy_rating_goes_to_the_blocks_its_user_touches(spark):
    import random
    rnd = random.Random(7)
    pairs = []
    for u in range(30):  # users keep to a corner of the products
        base = 40 * rnd.randrange(20)
        pairs += [(u, base + rnd.randrange(40)) for _ in range(25)]
    r = _ratings(spark, pairs)
    rows, heavy = item_cf._prepare(r, 2)
    units = item_cf._heavy_units(rows, block_products=20).cache()
    blocks = -(-len({p for _, p in pairs}) // 20)
    mine, seen = defaultdict(set), set()
    for x in units.select("user_id", "block", "product_id").distinct().collect():
        mine[x.user_id].add(x.block)
        seen.add((x.user_id, x.product_id))
    want = sum(len(mine[u]) for u, _ in seen)
    assert heavy and units.count() == want < len(seen) * blocks * 0.75
    want = _sims(item_cf.item_similarity(r))
    for t in (1, 5, 20):
        assert _sims(item_cf.item_similarity(r, heavy_user_products=t)) == want


def test_topk_in_parts_and_rounds_equals_brute_force_and_shuffles_no_pairs(spark):
    import random
    rnd = random.Random(11)
    pairs = [(rnd.randrange(40), rnd.choice((-7, 2**31 - 1, *range(30)))) for _ in range(900)]
    pairs += [(99, p) for p in range(30)] * 2 + [(None, 1), (None, 2), (5, None)]
    r = _ratings(spark, pairs)
    want = _brute([(u, p) for u, p in pairs if u is not None and p is not None], 5)
    n = Counter(p for _, p in pairs)  # ratings without a user count for the product, but pair with nothing
    for heavy, entries, rounds in ((2000, 50, 64), (20, 10, 7), (20, 1 << 20, 1 << 20)):
        out = item_cf.item_cf_recs(r, k=5, heavy_user_products=heavy, part_entries=entries, round_pairs=rounds)
        got = sorted(out.collect(), key=lambda x: (x.product_id, x.rank))
        assert {x.product_id for x in got} == set(want)
        scores = {(a, b): s for (a, b), s in _sims(item_cf.item_similarity(r, heavy_user_products=heavy)).items()}
        for p in want:
            ranked = sorted(((-s, b) for (a, b), s in scores.items() if a == p))[:5]
            assert [(-x.score, x.rec_product_id) for x in got if x.product_id == p] == ranked
            assert all(n[x.product_id] for x in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "p1" not in plan.split("MapInArrow")[0]  # no pair leaves the task that counts it


def test_topk_takes_long_ids(spark):
    rows = [(u, (1 << 40) + p) for u in range(4) for p in range(u, 9)]
    r = spark.createDataFrame(rows, "user_id int, product_id long")
    got = item_cf.item_cf_recs(r, k=3, part_entries=4, round_pairs=5).collect()
    by = defaultdict(list)
    for x in sorted(got, key=lambda x: (x.product_id, x.rank)):
        by[x.product_id].append(x.rec_product_id)
    assert dict(by) == _brute(rows, 3)


def test_dedupe_counts_each_user_and_product_once_in_parts(spark):
    import random
    rnd = random.Random(13)
    pairs = [(rnd.randrange(12), rnd.randrange(20)) for _ in range(300)]
    got = item_cf.item_cf_recs(_ratings(spark, pairs), k=4, heavy_user_products=14, dedupe=True, part_entries=30, round_pairs=9)
    by = defaultdict(list)
    for x in sorted(got.collect(), key=lambda x: (x.product_id, x.rank)):
        by[x.product_id].append(x.rec_product_id)
    assert dict(by) == _brute(sorted(set(pairs)), 4)


def test_lists_travel_in_narrow_types_to_few_parts(spark):
    ratings = _ratings(spark, [(u, (u * 7 + i) % 90) for u in range(200) for i in range(20)])
    rows, _ = item_cf._prepare(ratings, 2000)
    # 19 parts get 4000 * (1 - (18 / 19) ** 20) = 2644 entries each, 15 would get 2994
    assert item_cf._parts(rows, 2900) == (max(19, item_cf._parts(rows, 4000)[0]), "byte", "byte")
    assert item_cf._parts(item_cf._prepare(ratings, 5)[0], 1 << 20)[1:] == ("long", "byte")
    # 100 * 100 and sums past one and two bytes
    pairs = [(u, p) for u in range(5) for p, times in ((1, 100), (2, 100), (3, 127), (4, 1)) for _ in range(times)]
    for more in ([], [(9, 1)] * 200 + [(9, 4)]):
        r = _ratings(spark, pairs + more)
        got = {(x.product_id, x.rec_product_id): x.score for x in item_cf.item_cf_recs(r, k=5).collect()}
        assert got == _sims(item_cf.item_similarity(r))


def test_groups_of_parts_list_the_same_and_are_done_one_by_one(spark):
    ratings = _ratings(spark, [(u, (7 * u + 13 * i) % 90) for u in range(60) for i in range(12)] + [(1, 5), (1, 5), (None, 3)])
    for heavy, dedupe in ((2000, True), (5, False)):  # light users, and heavy ones
        want = [tuple(r) for r in item_cf.item_cf_recs(ratings, 10, heavy, dedupe).collect()]
        found = item_cf.item_cf_recs(ratings, 10, heavy, dedupe, part_entries=400, group_entries=4000)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan and plan.count("Relation [") > 1  # every group was counted and written
        assert sorted(tuple(r) for r in found.collect()) == sorted(want) and len(want) > 300
