from collections import defaultdict

import corpus_pipeline as cp
from pickwise.llm import quality
from tests.conftest import SF_SMALL
from tests.llm import brute


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_every_stage_equals_brute_force_on_its_input(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    outs = [docs]
    for name, stage in cp.STAGES:
        out = stage(spark, outs[-1], SF_SMALL)
        out.write.parquet(f"{tmp_dir}/{name}")
        outs.append(spark.read.parquet(f"{tmp_dir}/{name}"))
    assert all(o.columns == docs.columns for o in outs[1:-1])
    start, good, lines, unique, clean = map(_rows, outs[:-1])

    model = quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    assert good == {i: r for i, r in start.items() if scores[i] >= 0.5}

    want = brute.spread([(i, r["text"], r["source"]) for i, r in good.items()],
                        brute.sites_needed(r["source"] for r in good.values()))
    assert {i: r["text"] for i, r in lines.items()} == {i: w[2] for i, w in want.items()}

    groups = brute.minhash([(i, r["text"]) for i, r in lines.items()], 80)
    assert set(unique) == {i for i, (_, c) in groups.items() if i == c}

    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination([(i, r["text"]) for i, r in unique.items()], items)
    assert set(clean) == {i for i, (n, h, _) in hits.items() if not (h > 0 and 20 * h >= n)}

    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for r in outs[-1].collect():
        n = len(brute.blank_words(clean[r["doc_id"]]["text"]))
        assert r["size"] == n and 0 < r["taken"] <= 2 * n
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for r in clean.values():
        longest[r["source"]] = max(longest[r["source"]], len(brute.blank_words(r["text"])))
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in target.items())


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    words = [f"w{i}" for i in range(60)]
    copy, own, tail = " ".join(words), " ".join(f"own{i}" for i in range(60)), " ".join([*words[:59], "end"])
    rows = [(3, copy), (7, copy), (7, own), (7, own), (9, tail), (9, "short"), (None, own), (None, "null id"), (4, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r["doc_id"], r["text"]) for r in cp.drop_near_duplicates(spark, df, SF_SMALL).collect()]
    assert sorted(left, key=str) == sorted(
        [(3, copy), (7, own), (7, own), (9, "short"), (None, own), (None, "null id"), (4, None)], key=str)
