import random

from pickwise.llm import lines
from tests.llm import brute


def test_equals_brute_force_around_the_threshold(spark):
    rng = random.Random(8)
    pool = [f"line {i}" for i in range(60)] + ["", "  ", "é\t", " é"]
    docs = []
    for i in range(400):
        text = "\n".join(rng.choice(pool) if rng.random() < 0.3 else f"own {i} {k}" for k in range(rng.randrange(0, 8)))
        docs.append((i, text, f"s{min(rng.randrange(40), rng.randrange(40))}"))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for least in (5, 14, 20):
        got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in lines.dedup_lines(df, least).collect()}
        assert got == brute.spread(docs, least)


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    rows = [(1, "x\ny", None, 7), (2, "x", "a", 7), (3, " x\r", "b", 7), (3, "x", "b", 7), (4, None, "c", 7),
            (5, "", "d", 7), (None, "x", "e", 7), (6, "z " * 50_000, "e", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_removed int")
    out = lines.dedup_lines(df.selectExpr("*", "1 as id", "2 as pos"), 4).collect()
    by = {(r["doc_id"], r["source"]): (r["n_lines"], r["n_removed"], r["text"]) for r in out}
    assert by[None, "e"] == (1, 0, "x") and by[1, None] == (2, 1, "y") and by[2, "a"] == (1, 1, "")
    assert by[3, "b"] == (1, 1, "") and by[4, "c"] == (0, 0, None) and by[5, "d"] == (1, 0, "")
    assert len(out) == 8 and lines.dedup_lines(df.limit(0), 4).count() == 0


def test_equal_ids_with_other_texts_lose_only_their_own_lines(spark):
    rows = [(1, "x\nown a", "a"), (1, "own b\nx", "b"), (1, "own b\nx", "b"), (2, "x\nown c", "c"), (3, "own d\nown e", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = sorted((r["doc_id"], r["text"]) for r in lines.dedup_lines(df, 3).collect())
    assert out == [(1, "own b"), (1, "own b"), (1, "x\nown a"), (2, "own c"), (3, "own d\nown e")]


def test_a_long_text_of_boilerplate_is_cut_in_linear_time(spark):
    n = 60_000
    long = "\n".join(f"shared {i}" for i in range(n))
    df = spark.createDataFrame([(i, long + f"\nown {i}", f"s{i}") for i in range(3)], "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df, 3).collect()}
    assert out[0].startswith("shared 0\n") and (out[1], out[2]) == ("own 1", "own 2")


def test_threshold_follows_the_number_of_sites(spark):
    def needed(sites):
        return lines.sites_needed(spark.createDataFrame([(x,) for x in sites], "source string"))
    for n in (1, 3, 5, 6, 10, 11, 20, 21):
        assert needed([f"s{i}" for i in range(n)] * 2) == brute.sites_needed(range(n))
    assert needed([None, "a", None, ""]) == 3 and needed([]) == 3
