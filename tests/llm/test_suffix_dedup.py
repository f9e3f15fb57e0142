import random
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from pickwise.llm import suffix_dedup
from pickwise.llm.queries import op8_suffix_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def _result(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], r["n_spans"],
                   r["kept_sha256"]) for r in df.collect())


def _dedup(spark, tmp_dir, docs):
    path = f"{tmp_dir}/t{random.random()}"
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("sha256", F.lit("x")) \
        .write.parquet(f"{path}/documents.parquet")
    return _result(op8_suffix_dedup(spark, path))


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert _result(op8_suffix_dedup(spark, SF_SMALL)) == sorted(brute.repeats(docs))


@pytest.mark.parametrize("crowd", [None, 12, 0])
def test_passages_at_all_boundaries(spark, tmp_dir, monkeypatch, crowd):
    """Passages of 190 to 260 bytes in changing surroundings, periodic texts, small runs and ranges.

    All anchors are merged, those of hashes with over 12 contexts are counted by windows, or all of them.
    """
    if crowd is not None:
        monkeypatch.setattr(suffix_dedup, "repeated_spans", partial(suffix_dedup.repeated_spans, crowd=crowd))
    monkeypatch.setattr(suffix_dedup, "RUN_CONTEXTS", 40)
    monkeypatch.setattr(suffix_dedup, "RANGE_CONTEXTS", 60)
    rng = random.Random(5)

    def prose(n):
        return "".join(rng.choice("abcdefgh éü") for _ in range(n))
    passages = [prose(n) for n in (150, 180, 195, 199, 200, 201, 230, 260)]
    docs = []
    for i in range(120):
        text = prose(rng.randrange(0, 300))
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            cut = rng.choice((0, 0, 1, 7))
            text += p[cut:] + prose(rng.randrange(0, 60))
        docs.append((i, text))
    docs += [(200, "a" * 500), (201, "a" * 199), (202, "ab" * 150), (203, "xy" + "ab" * 120), (204, "é" * 100),
             (205, "é" * 100), (206, prose(199)), (207, passages[4]), (208, passages[4] + "!"),
             (209, passages[5][:150] * 5)]
    assert _dedup(spark, tmp_dir, docs) == sorted(brute.repeats(docs))


def test_windows_are_those_with_a_position_in_their_first_bytes():
    rng = random.Random(4)
    text = bytes(rng.choice(b"ab") for _ in range(900)) * 2
    for positions in ([0], [5, 700, 1790], [1600, 1601], list(range(1800))):
        starts, one, two = suffix_dedup.windows(text, positions)
        want = [s for s in range(len(text) - 199) if any(s <= p < s + suffix_dedup.SPREAD for p in positions)]
        assert starts.tolist() == want
        assert len(set(zip(one.tolist(), two.tolist()))) == len({text[s:s + 200] for s in want})


def test_large_group_goes_through_the_levels():
    rng = random.Random(2)

    def side(n, depth):
        return bytes(rng.choice(b"ab") if rng.random() < 0.02 * depth else 97 for _ in range(n))
    items = sorted({(side(200, 1), side(151, 1)) for _ in range(150)})
    rights = [0] + [suffix_dedup.lcp(a[0], b[0]) for a, b in zip(items, items[1:])]
    got = suffix_dedup.match_group(rights, [x[1] for x in items])
    want = []
    for i, (r, m) in enumerate(items):
        found = [(suffix_dedup.lcp(m, m2), suffix_dedup.lcp(r, r2)) for j, (r2, m2) in enumerate(items) if j != i]
        found = [(a, b) for a, b in found if a + b >= 200] or [(0, 0)]
        want.append((max(a for a, _ in found), max(b for _, b in found)))
    assert got == want


def test_loser_tree_merges_and_keeps_prefixes():
    rng = random.Random(1)
    streams = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(20)))
               for _ in range(11)]
    coded = []
    for s in streams:
        shared, _ = suffix_dedup.front_code(s)
        coded.append([(n, (x,)) for n, x in zip(shared, s)])
    out = list(suffix_dedup.LoserTree(coded))
    merged = [x[0] for _, x in out]
    assert merged == sorted(x for s in streams for x in s)
    assert [n for n, _ in out][1:] == [suffix_dedup.lcp(a, b) for a, b in zip(merged, merged[1:])]


def test_null_empty_repeated_and_no_rows(spark, tmp_dir):
    long = "".join(random.Random(9).choice("abcdefghij ") for _ in range(90_000))
    docs = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, long), (4, long), (None, long[500:900]), (6, long[100:])]
    want = sorted((i if i is not None else -1, *rest) for i, *rest in brute.repeats(docs))
    assert _dedup(spark, tmp_dir, docs) == want
    assert _dedup(spark, tmp_dir, []) == []


def test_texts_of_one_id_are_documents_of_their_own(spark, tmp_dir):
    """A copy of another document does not take other texts of its id out of the search."""
    rng = random.Random(12)

    def prose(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))
    copy, shared = prose(700), prose(300)
    docs = [(5, copy), (2, copy), (5, prose(150) + shared + prose(80)), (3, prose(90) + shared), (5, prose(400)),
            (None, shared + prose(50)), (None, prose(500)), (None, copy)]
    want = sorted((i if i is not None else -1, *rest) for i, *rest in brute.repeats(docs))
    assert _dedup(spark, tmp_dir, docs) == want


def test_class_keys_rule_out_only_strings_that_occur_once():
    rng = random.Random(3)
    shared = bytes(rng.choice(b"abcd") for _ in range(420))
    texts = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(300))) + shared[k:k + 260] for k in (0, 40, 90)]
    seen, spots = {}, []
    for t, text in enumerate(texts):
        at, _ = suffix_dedup.anchors(text)
        for key, p, j in suffix_dedup.class_keys(text, at.tolist()):
            seen.setdefault(key, set()).add((t, p))
            spots.append((t, p, j, key))
    left = {(t, s) for t, p, j, key in spots if len(seen[key]) > 1
            for s in range(p - suffix_dedup.CLASS * (j + 1) + 1, p - suffix_dedup.CLASS * j + 1)}
    places = {}
    for t, text in enumerate(texts):
        for s in range(len(text) - 199):
            places.setdefault(text[s:s + 200], []).append((t, s))
    twice = {x for where in places.values() if len(where) > 1 for x in where}
    assert twice and twice <= left and len(left) < sum(map(len, texts)) / 2


def test_texts_are_shuffled_only_to_be_stored(spark, tmp_dir, monkeypatch):
    """With nothing broadcast, neither the search nor the cut sends texts through an exchange."""
    plans = []

    def exchanged(df):
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        plans.append(re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[(.*)\]", plan))

    def stored(df, name):
        exchanged(df)
        return kept(df, name)
    kept = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", stored)
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared, copy = prose(300), prose(500)
    docs = [(i, prose(rng.randrange(100, 400)) + shared) for i in range(30)] + [(40, copy), (41, copy), (42, None)]
    path = f"{tmp_dir}/t"
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for crowd in (suffix_dedup.CROWD, 0):
            monkeypatch.setattr(suffix_dedup, "repeated_spans", partial(suffix_dedup.repeated_spans, crowd=crowd))
            df = op8_suffix_dedup(spark, path)
            exchanged(df)
            assert _result(df) == sorted(brute.repeats(docs))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sum(map(len, plans)) > 10
    assert not [columns for plan in plans for columns in plan if re.search(r"\btext#", columns)]
