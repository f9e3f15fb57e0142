import numpy as np

from pickwise.llm import cap_dedup
from pickwise.llm.queries import op2_embedding_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def _result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    assert _result(op2_embedding_dedup(spark, SF_SMALL)) == brute.vectors(rows)


def _clusters(seed, dim, n_clusters, members, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n_clusters):
        centre = rng.standard_normal(dim)
        for _ in range(members):
            v = centre / np.linalg.norm(centre) + noise * rng.standard_normal(dim) / np.sqrt(dim)
            rows.append(v.tolist())
    return [(i, v, int(i % 2)) for i, v in enumerate(rows)]


def test_clusters_near_the_threshold(spark, monkeypatch):
    """Pairs fall on either side of 0.93; blocks of 7 rows force pairs of blocks."""
    monkeypatch.setattr(cap_dedup, "BLOCK_ROWS", 7)
    for dim, noise in ((64, 0.27), (100, 0.26), (7, 0.2)):
        rows = _clusters(dim, dim, 8, 30, noise)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got, want = _result(cap_dedup.near_duplicates(df)), brute.vectors(rows)
        assert sum(n for n, _ in got.values()) >= 0.999 * sum(n for n, _ in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)
        if dim != 64:
            continue
        assert got == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [1e-200, 1e-210], 1), (14, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = _result(cap_dedup.near_duplicates(df.selectExpr("*", "'x' as digest", "1 as id")))
    want = {i: (0, i) for i in range(1, 15)}
    want.update({1: (3, 1), 2: (3, 1), 12: (3, 1), 13: (3, 1)})
    assert got == want
    assert cap_dedup.near_duplicates(df.limit(0)).count() == 0


def test_equal_rows_and_null_ids(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)],
                               "vec_id long, embedding array<double>, label int")
    rows = cap_dedup.near_duplicates(df).collect()
    assert [(r["n_links"], r["component_id"]) for r in rows if r["vec_id"] == 5] == [(1, 5), (1, 5)]


def test_recall_of_single_pairs_at_the_threshold():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = rng.standard_normal((400, 64))
    w -= (w * x).sum(axis=1, keepdims=True) * x
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    codes = [cap_dedup._code(64, k) for k in range(cap_dedup.CODES)]
    a = cap_dedup.list_decode(x, codes)
    b = cap_dedup.list_decode(0.93 * x + np.sqrt(1 - 0.93 ** 2) * w, codes)
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) >= 0.99
