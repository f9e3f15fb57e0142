import random

import pytest

from pickwise.llm import decontam
from tests.llm import brute


def _texts(seed):
    rng = random.Random(seed)
    vocabulary = ["aa", "bb", "cc", "dd"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 3, 12, 13, 14, 30))))) for i in range(30)]
    docs = []
    for i in range(150):
        words = [rng.choice([*vocabulary, "zz"]) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            words[len(words) // 2:1] = rng.choice(items)[1].upper().split()
        docs.append((i, ", ".join(words)))
    return docs, items


@pytest.mark.parametrize("shard_words", [2_000_000, 60])
def test_scan_equals_brute_force(spark, shard_words):
    docs, items = _texts(5)
    got = decontam.scan(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words)
    want = brute.contamination(docs, items)
    for r in got.collect():
        n_words, n_hit, names = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], set(r["items"])) == (n_words, n_hit, names)
        assert r["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)
        ends = [s["end"] for s in r["spans"]]
        assert all(a < s["start"] for a, s in zip(ends, r["spans"][1:]))


def test_long_items_only(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(60))) for i in range(5)]
    docs = [(0, items[0][1][4:40]), (1, " ".join(items[1][1].split()[:12])), (2, " ".join(items[1][1].split()[5:18]))]
    got = decontam.scan(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.contamination(docs, items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], set(r["items"])) for r in got} == want


def test_actions(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"A {passage} B", "k"), (2, "clean", "k"), (3, f"{'w ' * 900}{passage}", "k"), (4, None, "k")],
                                 "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, bench).collect()}
    assert set(kept) == {2, 3, 4}
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, bench, action="cut").collect()}
    assert cut[1] == "a b" and cut[2] == "clean" and cut[3].endswith("q19") and cut[4] is None


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "x"), (4, None), (5, ""), (6, "x")], "item_id long, text string")
    for words in (2_000_000, 1):
        rows = decontam.scan(docs, bench, shard_words=words).collect()
        assert sorted((r["doc_id"] or 0, r["n_hit"], tuple(r["items"])) for r in rows) == [
            (0, 1, ("", "6")), (1, 1, ("", "6")), (1, 1, ("", "6")), (2, 0, ())]
    assert [r["n_hit"] for r in decontam.scan(docs, bench.limit(0)).collect()] == [0] * 4
    assert decontam.scan(docs.limit(0), bench).count() == 0


def test_a_contaminated_row_leaves_others_of_its_id_alone(spark):
    passage, other = " ".join(f"q{i}" for i in range(20)), "One, two Q3"
    rows = [(1, f"A {passage}"), (1, other), (1, other), (None, f"b {passage}"), (None, other), (None, None), (2, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage), (8, "zz yy xx")], "item_id long, text string")
    for words in (2_000_000, 2):
        left = [tuple(r) for r in decontam.decontaminate(docs, bench, shard_words=words).collect()]
        assert sorted(left, key=str) == sorted([(1, other), (1, other), (None, other), (None, None)], key=str)
        cut = [tuple(r) for r in decontam.decontaminate(docs, bench, action="cut", shard_words=words).collect()]
        assert sorted(cut, key=str) == sorted(
            [(1, "a"), (1, other), (1, other), (None, "b"), (None, other), (None, None), (2, "")], key=str)


def test_a_long_item_is_cut_without_losing_a_window(spark):
    words = [b"w%d" % (i % 97 + i // 50) for i in range(900)]
    for most in (26, 27, 100, 888, 899, 900):
        parts = decontam.pieces(words, most, 13)
        assert all(13 <= len(p) <= most for p in parts)
        assert {tuple(p[k:k + 13]) for p in parts for k in range(len(p) - 12)} == {
            tuple(words[k:k + 13]) for k in range(888)}
    text = b" ".join(words).decode()
    cut = [text[200:420], text[3000:3300], " ".join(text.split()[20:34]), "w1 w2 w3 unrelated", text]
    docs = spark.createDataFrame(list(enumerate(cut)), "doc_id long, text string")
    items = spark.createDataFrame([("long", text), ("short", "w1 w2 w3")], "item_id string, text string")
    want = brute.contamination(list(enumerate(cut)), [("long", text), ("short", "w1 w2 w3")])
    for size in (300, 250_000):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], set(r["items"]))
               for r in decontam.scan(docs, items, shard_words=size).collect()}
        assert got == want and all(len(r["items"]) == len(set(r["items"])) for r in decontam.scan(docs, items, shard_words=size).collect())
