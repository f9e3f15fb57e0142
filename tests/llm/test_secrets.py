import itertools
import math
import random
import re

import pytest

from pickwise.llm import secrets

SCHEMA = "doc_id long, text string"
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(text):
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text or "") if len(m.group(2)) >= 8]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m.group()) >= 16]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[1])))


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as value", "3 as lang", "4 as bits")
    return [(r["doc_id"], [(s["start"], s["kind"], s["end"]) for s in r["base"]],
             [(s["start"], s["kind"], s["end"]) for s in r["spans"]]) for r in secrets.scan_secrets(df).collect()]


def segment_bits(v, words):
    """Cost of one whole segment, or None: the segment kinds written out one by one."""
    n, options = len(v), []
    low, leet = v.lower(), secrets.normal(v)
    for text in (low, leet):
        if secrets.SHORTEST <= n <= secrets.LONGEST and text in words:
            options.append(words[text] + secrets._spelling_bits(v, text))
    for p in range(1, secrets.PERIODS + 1):
        if n >= max(2 * p, 3) and all(v[k] == v[k - p] for k in range(p, n)):
            unit = min(sum(map(secrets._char_bits, v[:p])), words.get(low[:p], math.inf))
            options.append(unit + math.log2(n / p))
    if m := secrets.DATE.fullmatch(v):
        options.append(secrets.YEAR_BITS if n == 4 else secrets.DAY_BITS + 2 * bool(m.group(1) or m.group(2)))
    steps = {ord(b) - ord(a) for a, b in zip(low, low[1:])}
    if n >= 3 and low.isalnum() and steps in ({1}, {-1}):
        options.append(math.log2(36) + 1 + math.log2(n))
    keys = low.translate(secrets.SHIFTED)
    if n >= 3 and all(b in secrets.NEAR.get(a, ()) for a, b in zip(keys, keys[1:])):
        ways = [secrets._direction(a, b) for a, b in zip(keys, keys[1:])]
        turns = 1 + sum(a != b for a, b in zip(ways, ways[1:]))
        options.append(secrets.WALK_BITS + turns * secrets.TURN_BITS + math.log2(n))
    return options


def cheapest(v, words):
    """Every segmentation tried."""
    words = {**words, **{w: min(words.get(w, 99.0), math.log2(r + 2)) for r, w in enumerate(secrets.COMMON)}}
    best = math.inf
    for cuts in itertools.product((False, True), repeat=len(v) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(v)]
        best = min(best, len(at) - 2 + sum(
            min([sum(map(secrets._char_bits, v[a:b]))] + segment_bits(v[a:b], words)) for a, b in zip(at, at[1:])))
    return best


@pytest.mark.parametrize("value", ["horse2019!", "Tr0ub4dor", "aaaaaa7", "abcabcabc", "qwerty12", "zxcvfr4", "19991231x",
                                   "p@ssw0rd", "cbaHORSE", "x9$Kq2vL", "31-12-1999", "!QAZxsw2", "é1é1é1"])
def test_cost_never_beats_and_nearly_reaches_the_best_segmentation(value):
    words = {"horse": 9.0, "troubador": 12.0, "hor": 8.0}
    got, want = secrets.guess_bits(value, words), cheapest(value, words)
    # runs are read at full length only, which may cost a bit more than their best cut
    assert want - 1e-9 <= got <= want + 3


def test_hard_values_cost_more_than_easy_ones():
    words = {"correct": 8.0, "horse": 9.0}
    bits = [secrets.guess_bits(v, words) for v in ("aaaaaaaaaaaa", "password2019", "correctHorse", "qwertyuiop", "xK4#pQz9!mRw")]
    assert max(bits[:4]) < secrets.MIN_BITS < bits[4]


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(2)
    bits = ["password", "PassWd", "secret", "ſecret", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "é𐀀", "\n",
            "AKIA", "ABCD1234EF", "Z9", "0123456789abcdef" * 2, "deadbeef", "x", "longvalue+/_.=-", "tok", "G"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(25)))) for i in range(600)]
    got = found(spark, rows)
    assert len(got) == 600
    texts = dict(rows)
    for i, base, spans in got:
        assert base == brute_base(texts[i])
        assert [s for s in spans if s[1] != "guess"] == base


def test_the_method_adds_values_that_are_hard_to_guess(spark):
    hard, easy = "xK4#pQz9!mRw", "summerhouse"
    rows = [(i, "the summerhouse password is summerhouse.") for i in range(5)]
    rows += [(10, f"é passphrase: {hard}, and pwd={easy}"), (11, f"Authorization: Bearer {hard}"), (12, f"nothing {hard}"),
             (13, "my password is safe"), (14, f"secret: {'xy' * 60_000}"), (15, f"password=abcdefgh1 pass: {hard}"),
             (16, f"passphrase={hard}" * 2)]
    by = {i: spans for i, _, spans in found(spark, rows)}
    assert by[10] == [(14, "guess", 26)] and by[11] == [(22, "guess", 34)] and by[12] == [] and by[13] == [] and by[0] == []
    assert by[14] == [(0, "assign", 8 + 120_000)] and by[15] == [(0, "assign", 18), (25, "guess", 37)]
    assert by[16][0] == (11, "guess", 11 + len(hard) + len("passphrase=" + hard))


def test_nulls_repeats_long_values_and_no_rows(spark):
    rng = random.Random(1)
    value = "".join(rng.choice("abcdXYZ#$%&*~") for _ in range(30_000))
    rows = [(1, None), (1, ""), (None, "pwd: xK4#pQz9!mRw"), (None, "pwd: xK4#pQz9!mRw"), (2, "pwd: " + value)]
    got = sorted(found(spark, rows), key=str)
    assert got == sorted([(1, [], []), (1, [], []), (None, [], [(5, "guess", 17)]), (None, [], [(5, "guess", 17)]),
                          (2, [], [(5, "guess", 30_005)])], key=str)
    assert found(spark, []) == []
