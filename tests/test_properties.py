"""Randomised equality with brute force (few examples: each runs Spark jobs)."""

import math
from collections import Counter, defaultdict
from itertools import product

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pickwise import schemas
from pickwise.operators import item_cf, similarity

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ratings_lists = st.lists(st.tuples(st.integers(0, 12), st.integers(-5, 25)), min_size=2, max_size=120)


def _brute_top(pairs, k):
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


@SETTINGS
@given(pairs=ratings_lists, heavy=st.sampled_from([2, 5, 2000]), k=st.integers(1, 4))
def test_item_cf_top_k_equals_brute_force(spark, pairs, heavy, k):
    r = spark.createDataFrame([(u, p, 1.0, 0) for u, p in pairs], schemas.RATING)
    got = defaultdict(list)
    for row in sorted(item_cf.item_cf_recs(r, k=k, heavy_user_products=heavy).collect(),
                      key=lambda x: (x.product_id, x.rank)):
        got[row.product_id].append(row.rec_product_id)
    assert dict(got) == _brute_top(pairs, k)


entries = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 8), st.integers(1, 4)),
                   min_size=1, max_size=90)


@SETTINGS
@given(rows=entries, t=st.sampled_from([0.2, 0.5, 0.8]))
def test_sparse_cosine_equals_brute_force(spark, rows, t):
    dense = np.zeros((31, 9))
    for i, d, w in rows:
        dense[i, d] = w  # last write wins, like the DataFrame below
    data = [(i, d, float(dense[i, d])) for i in range(31) for d in range(9) if dense[i, d] > 0]
    df = spark.createDataFrame(data, "id int, dim int, w double")
    norms = np.linalg.norm(dense, axis=1)
    want = set()
    for i in range(31):
        for j in range(31):
            if i != j and norms[i] > 0 and norms[j] > 0:
                if dense[i] @ dense[j] / (norms[i] * norms[j]) > t + 1e-12:
                    want.add((i, j))
    got = {(r.id, r.other_id) for r in similarity.cosine_pairs_sparse(df, threshold=t).collect()}
    # pairs within 1e-12 of the threshold may go either way
    border = {(i, j) for i in range(31) for j in range(31) if i != j and norms[i] > 0 and norms[j] > 0
              and abs(dense[i] @ dense[j] / (norms[i] * norms[j]) - t) <= 1e-12}
    assert got - border == want - border
