import random

import pytest

from pickwise.llm import minhash, storage
from pickwise.llm.queries import op6_minhash
from tests.conftest import SF_SMALL
from tests.llm import brute


def _result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = op6_minhash(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.minhash(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def _near_copies(seed, groups, copies):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((8, 30, 60, 200)))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block_rows", [1024, 5])
def test_chains_of_near_copies_equal_brute_force(spark, monkeypatch, block_rows):
    """Copies with edits of their own: many pairs lie just above and just below the threshold."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block_rows)
    docs = _near_copies(3, 12, 14)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _result(minhash.near_duplicates(df)) == brute.minhash(docs)


def test_edge_cases(spark):
    words = " ".join(f"w{i}" for i in range(40))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "two one"),
            (7, words), (8, words.upper()), (9, "É"), (10, "é"), (11, "tail " * 30_000)]
    df = spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, id string, component int")
    assert _result(minhash.near_duplicates(df)) == brute.minhash(docs)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(4, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (None, "q r s")],
                               "doc_id long, text string")
    rows = minhash.near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"]) == [(2, 2), (4, 2), (4, 2)]
    assert [r["n_shingles"] for r in rows if r["doc_id"] is None] == [1]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_all_texts_of_an_id_link_it(spark):
    rng = random.Random(6)

    def near(words):
        w = list(words)
        w[rng.randrange(len(w))] = "changed"
        return " ".join(w)
    a, b = ([f"w{rng.randrange(9999)}" for _ in range(120)] for _ in range(2))
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(b)), (5, "on its own words here now"),
            (None, " ".join(a)), (None, "a b c d e f g")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()]
        assert sorted(got, key=str) == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False),
                                               (5, 5, True), (None, None, True), (None, None, True)], key=str)


def test_signed_rows_stay_and_band_rows_move_once(spark, monkeypatch):
    """Rows of bands and signatures went through a join by set and a removal of repeats, twice."""
    plans = {}

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return storage.stored(df, name)
    monkeypatch.setattr(minhash, "stored", kept)
    docs = _near_copies(8, 5, 6)
    docs += [(100 + i, t) for i, t in docs[:9]] + docs[:4]
    want = brute.minhash(docs)
    assert _result(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == want
    moves = {n: [line for line in p.splitlines() if "hashpartitioning(" in line] for n, p in plans.items()}
    assert len(moves["minhash-members"]) == 1 and "hashpartitioning(band" in moves["minhash-members"][0]
    assert not any("hashpartitioning(digest" in line for line in moves["minhash-signatures"])
