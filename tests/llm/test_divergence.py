import random
import re
from collections import Counter, defaultdict

import pytest

from pickwise.llm import divergence
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def audit(rows, top=200):
    """Sorted result rows, every share of every kept term spelled out."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(brute.LOWER))
        groups[lang].add(source)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= 3), key=str.encode)
        v = len(kept)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + v) for t in kept}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: shares(counts[lang, s]) for s in sources}

        def f(p, q):
            return (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items)
                        if part == "pair" or k < top]
    return sorted(out)


def audited(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as v", "3 as term", "4 as idx")
    return sorted(tuple(r) for r in divergence.audit_sources(df, **kw).collect())


@pytest.mark.parametrize("block, held, top", [(128, 200_000, 200), (3, 20, 7)])
def test_equals_brute_force_with_blocks_of_any_size(spark, monkeypatch, block, held, top):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence, "PAIR_CHUNK", 50)
    rng = random.Random(4)
    rows = []
    for i in range(500):
        words = [f"{'Éa'[k % 2]}w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
        text = " ".join(words[min(rng.randrange(300), rng.randrange(300))] for _ in range(rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "de", None]), f"s{min(rng.randrange(11), rng.randrange(11))}"))
    rows += [(900, "only here", "fr", "a"), (901, "", "fr", "b"), (902, None, "fr", None), (903, "x", "lone", "z")]
    assert audited(spark, rows, top=top) == audit(rows, top)


def test_ties_nulls_repeats_long_texts_and_no_rows(spark):
    rows = [(1, "b a c", "en", "x")] * 3 + [(2, "ﬀ d 𐀀 ￿ D1d", "en", "y")] * 3 + [(None, "the " * 60_000, "en", "y")] * 3
    rows += [(3, "a,B;c", "en", None), (4, None, None, None), (5, "d d d", None, "x"), (6, "\x00e-f_g", "en", "")]
    got = audited(spark, rows)
    assert got == audit(rows)
    tied = [r[3] for r in sorted(got, key=lambda r: r[5]) if r[:3] == ("en", "x", "term")]
    assert tied == ["b", "a", "c"] or tied == sorted(tied)
    assert audited(spark, []) == []


def test_counts_beyond_an_int_stay_exact(spark):
    df = spark.createDataFrame([(12_345_678_901_234, 98_765_432_109, 7)], "n long, total long, v long")
    got = df.select(divergence._share("n", "total", "v").alias("p")).first()["p"]
    assert got == 1 + 10**9 * 12_345_678_901_235 // (98_765_432_109 + 7)
