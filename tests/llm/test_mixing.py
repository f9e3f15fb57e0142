import random
from collections import defaultdict

from pyspark.sql import functions as F

from pickwise.llm import mixing
from pickwise.llm.queries import op3_mixing
from tests.conftest import SF_SMALL
from tests.llm import brute


def _targets(sizes):
    """Water level by bisection, an independent way to the same quotas."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, lo, hi = 1.5 * sum(sizes.values()), 0.0, 4.0 * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(mid * weight[s], 2 * sizes[s]) for s in names) < total:
            lo = mid
        else:
            hi = mid
    return {s: min(hi * weight[s], 2 * sizes[s]) for s in names}


def _check(rows, docs, near):
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, text, source in docs:
        sizes[source] += len(brute.blank_words(text))
    want = _targets(sizes)
    source = {i: s for i, _, s in docs}
    words = {i: len(brute.blank_words(t)) for i, t, _ in docs}
    assert sorted(r["doc_id"] for r in rows) == sorted(source)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[s]
        assert abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near(s), (s, taken[s], want[s])


def test_query_meets_its_targets(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = op3_mixing(spark, SF_SMALL).collect()
    _check(rows, docs, lambda s: max(len(brute.blank_words(t)) for _, t, x in docs if x == s) / 2 + 1)
    again = {r["doc_id"]: r["taken"] for r in op3_mixing(spark, SF_SMALL).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_many_buckets_and_uneven_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rng = random.Random(6)
    docs = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a", "b", "c", "d", None, "", "é", "Z"]))
            for i in range(600)]
    docs += [(1000, "w " * 5000, "b"), (1001, None, "a"), (1002, "", "lonely")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as pattern")
    rows = mixing.mix_sources(df, F.array("source")).collect()
    _check(rows, docs, lambda s: 2 if s != "b" else 2500)


def test_flow_prefers_unused_tokens_over_repetition():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 10)]
    flow = mixing.route(patterns, {"a": 120, "b": 90})
    used = [sum(v for (p, _), v in flow.items() if p == k) for k in range(3)]
    assert sum(used) == 210 and used == [100, 100, 10]
    assert sum(v for (_, s), v in flow.items() if s == "a") == 120
    flow = mixing.route(patterns, {"a": 150, "b": 150})
    assert sum(v for (_, s), v in flow.items() if s == "b") == 150  # 90 repeated words in all, none over twice
    assert all(sum(v for (p, _), v in flow.items() if p == k) <= 2 * n for k, (_, n) in enumerate(patterns))
    assert mixing.route([((), 5)], {}) == {}


def test_overlapping_sources_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", ["x", "y"]), (1, "a b", ["x", "y"]), (None, "c", None), (3, "d e f", ["y", None])],
                               "doc_id long, text string, s array<string>")
    rows = mixing.mix_sources(df, F.col("s")).collect()
    assert len(rows) == 4 and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert [r["taken"] for r in rows if r["doc_id"] is None] == [0]
    assert mixing.mix_sources(df.limit(0), F.col("s")).count() == 0
