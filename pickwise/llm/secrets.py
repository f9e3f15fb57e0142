"""Secret scans: fixed patterns, and password guess cost of values that stand in a credential context.

Base spans are the matches of three patterns (assignments to credential names,
cloud access keys, long hexadecimal runs). The method adds values that follow a
credential word in a wider sense (``pwd``, ``passphrase``, ``Authorization:
Bearer``, ``the password is ...``, with any characters) and are hard to guess.

How many guesses a value takes is estimated by a dynamic program over its
characters (Wheeler, "zxcvbn", USENIX Security 2016): the cheapest
segmentation into dictionary words (with bits for capitals and for digits in
place of letters), dates and years, repeats of a unit, alphabet and digit runs,
keyboard walks, and brute-force spans, one bit for each further segment. Costs
are bits. A word costs log2(all words / its occurrences): the dictionary is the
counts of the whole corpus without the found values themselves, and words in
fewer than ``MIN_DOCS`` documents are none. No dictionary is broadcast: the parts of the distinct values are joined
with the counts, and every value meets only its own words. Each segment kind is
read off in time linear in the value, so no value is cut or skipped.

Values of at least ``MIN_BITS`` become spans of kind ``guess`` unless a base
span covers them.

Defined cases: a null text is empty and has no spans; equal rows and rows with
equal or null ids are scanned each on its own; a very long text is one text, a
very long value one value; no rows give no rows; other columns are ignored.
Words of more than ``LONGEST`` letters count as brute force.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.divergence import count_words
from pickwise.llm.storage import stored

MIN_BITS, MIN_DOCS = 40.0, 3
SHORTEST, LONGEST = 3, 20  # letters of a dictionary word
PERIODS = 8  # longest unit of a repeat

# fixed values: kinds of base spans, their patterns and the least length of what counts
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]{32,}"
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ["assign", "access", "hex", "guess"]
# what a credential value follows: a name and a sign, or an authorisation scheme
CONTEXT = (r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|"""
           r"""(?:api|access|private|auth|signing)[_-]?key)s?["'`]?\x20?(?::=|=>|[:=]|is\x20)\x20*["'`]?([^\s"'`<>,;]+)"""
           r"""|(?<![a-z])(?:bearer|basic)\x20+["'`]?([^\s"'`<>,;]+)""")
TRAILING = ".:)]}"
# common passwords and stand-ins, cheapest first (fixed values)
COMMON = ("password secret admin user test example changeme qwerty letmein welcome login default root guest "
          "master dragon monkey shadow sunshine princess football iloveyou your my here token key xxx none null "
          "true false redacted placeholder hidden pass demo sample").split()
LEET = str.maketrans("4301!$5@7", "aeoiissat")
KEYS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")  # rows of a keyboard, each half a key further
SHIFTED = str.maketrans("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|[12]\d|3[01])\2(?:19|20)\d\d"
                  r"|(?:19|20)\d\d", re.ASCII)
DAY_BITS, YEAR_BITS = math.log2(366 * 130), math.log2(130)


def _neighbours() -> dict[str, set[str]]:
    at = {c: (y, x) for y, row in enumerate(KEYS) for x, c in enumerate(row) if c != " "}
    near = ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1))
    return {c: {d for d, (v, u) in at.items() if (v - y, u - x) in near} for c, (y, x) in at.items()}


NEAR = _neighbours()
WALK_BITS, TURN_BITS = math.log2(len(NEAR)), math.log2(sum(map(len, NEAR.values())) / len(NEAR))


def normal(value: str) -> str:
    """ASCII-lowered value, with digits and signs that stand for letters put back; same length."""
    low = "".join(c.lower() if c.isascii() else c for c in value)
    return low.translate(LEET)


def parts(value: str) -> list[str]:
    """Distinct letter runs within the value that could be words."""
    found = set()
    plain = "".join(c.lower() if c.isascii() else c for c in value)
    for text in {plain, normal(value)}:
        for run in re.finditer(r"[^\x00-\x60\x7B-\x7F]+", text):
            w = run.group()
            for i in range(len(w) - SHORTEST + 1):
                found.update(w[i:j] for j in range(i + SHORTEST, min(len(w), i + LONGEST) + 1))
    return sorted(found)


def _char_bits(c: str) -> float:
    if c.isdigit() and c.isascii():
        return math.log2(10)
    if c.isalpha() and c.isascii():
        return math.log2(26)
    return math.log2(33) if c.isascii() else math.log2(128)


def _spelling_bits(seen: str, word: str) -> float:
    """Bits for the capitals of a word and for the letters written as digits or signs."""
    upper, n = sum(c.isupper() for c in seen), len(seen)
    caps = 0.0 if not upper else 1.0 if upper == n or (upper == 1 and seen[0].isupper()) else math.log2(
        sum(math.comb(n, k) for k in range(1, min(upper, n - upper) + 1)))
    return caps + sum(a.lower() != b for a, b in zip(seen, word) if a.isascii())


def guess_bits(value: str, words: dict[str, float]) -> float:
    """Bits of the cheapest segmentation; ``words`` gives the bits of dictionary words."""
    n = len(value)
    if not n:
        return 0.0
    words = {**words, **{w: min(words.get(w, 99.0), math.log2(r + 2)) for r, w in enumerate(COMMON)}}
    plain, leet = "".join(c.lower() if c.isascii() else c for c in value), normal(value)
    keys = plain.translate(SHIFTED)
    bits = [_char_bits(c) for c in value]
    total = [0.0]
    for b in bits:
        total.append(total[-1] + b)
    dates: dict[int, list] = {}
    for i in range(n):  # a date may start anywhere, also within another
        if value[i].isdigit() and (m := DATE.match(value, i)):
            long = m.end() - i > 4
            dates.setdefault(m.end(), []).append((i, DAY_BITS + 2 * bool(m.group(1) or m.group(2)) if long else YEAR_BITS))
    best, brute = [0.0] + [math.inf] * n, math.inf
    repeat = [0] * (PERIODS + 1)  # how many characters up to here equal the one a period before
    walk, turns, way = 1, 0, None
    run, step = 1, 0
    for j in range(1, n + 1):
        options = []
        for size in range(SHORTEST, min(LONGEST, j) + 1):
            i = j - size
            for text in (plain, leet):
                if (cost := words.get(text[i:j])) is not None:
                    options.append((i, cost + _spelling_bits(value[i:j], text[i:j])))
        for period in range(1, min(PERIODS, j - 1) + 1):
            repeat[period] = repeat[period] + 1 if value[j - 1] == value[j - 1 - period] else 0
            size = repeat[period] + period
            if size >= max(2 * period, 3):
                i = j - size
                unit = min(total[i + period] - total[i], words.get(plain[i:i + period], math.inf))
                options.append((i, unit + math.log2(size / period)))
        if j > 1:
            a, b = keys[j - 2], keys[j - 1]
            if b in NEAR.get(a, ()):
                now = _direction(a, b)
                turns, walk, way = (turns + (now != way), walk + 1, now) if walk > 1 else (1, 2, now)
            else:
                walk, turns, way = 1, 0, None
            if walk >= 3:
                options.append((j - walk, WALK_BITS + turns * TURN_BITS + math.log2(walk)))
            delta = ord(plain[j - 1]) - ord(plain[j - 2])
            same_kind = plain[j - 1].isalnum() and plain[j - 2].isalnum()
            if abs(delta) == 1 and same_kind:
                run, step = (run + 1, step) if run > 1 and delta == step else (2, delta)
            else:
                run, step = 1, 0
            if run >= 3:
                options.append((j - run, math.log2(36) + 1 + math.log2(run)))
        options += dates.get(j, ())
        brute = min(brute, best[j - 1] + (j > 1)) + bits[j - 1]
        best[j] = min([brute] + [best[i] + (i > 0) + max(cost, 0.0) for i, cost in options])
    return best[n]


def _direction(a: str, b: str) -> tuple[int, int]:
    (y, x), (v, u) = ((row, KEYS[row].index(c)) for c in (a, b) for row in range(len(KEYS)) if c in KEYS[row])
    return v - y, u - x


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def credential_values(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the values in a credential context that no base span covers."""
    out, covered = [], sorted((s, e) for s, _, e in base)
    reach, k = 0, 0  # the furthest end of base spans that start at or before the value
    for m in _CONTEXT.finditer(text):
        g = 1 if m.group(1) is not None else 2
        start, end = m.start(g), m.start(g) + len(m.group(g).rstrip(TRAILING))
        while k < len(covered) and covered[k][0] <= start:
            reach, k = max(reach, covered[k][1]), k + 1
        if end > start and end > reach:
            out.append((start, end))
    return out


_ASSIGN, _CONTEXT = (re.compile(p, re.ASCII | re.IGNORECASE) for p in (ASSIGN, CONTEXT))
_ACCESS, _HEX = re.compile(ACCESS), re.compile(HEX)

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_VALUE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def _scan(batches):
    """(id, text) -> (id, base spans, credential values)."""
    for batch in batches:
        base, values = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            spans = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            values.append([{"start": s, "end": e, "value": text[s:e]} for s, e in credential_values(text, spans)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(_SPAN)),
                                          pa.array(values, pa.list_(_VALUE))], names=["id", "base", "found"])


def _count_rest(batches):
    """(lang, source, text) -> counts of the words outside all found values."""
    def rest():
        for batch in batches:
            plain = []
            for text in batch.column(2):
                text = text.as_py() or ""
                base = base_spans(text)
                keep, at = [], 0
                for start, end in sorted([(s, e) for s, _, e in base] + credential_values(text, base)):
                    keep.append(text[at:start])
                    at = max(at, end)
                plain.append(" ".join([*keep, text[at:]]).encode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(plain, pa.binary())],
                                             names=["lang", "source", "text"])
    yield from count_words(rest())


def _parts(batches):
    for batch in batches:
        for value in batch.column(0).to_pylist():
            words = parts(value)
            for at in range(0, len(words), 50_000):
                some = words[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([value] * len(some), pa.string()), pa.array(some, pa.string())],
                                                 names=["value", "word"])


def _guess(batches):
    for batch in batches:
        known = batch.column(1).to_pylist()
        bits = [guess_bits(v, {w["word"]: w["bits"] for w in ws or []})
                for v, ws in zip(batch.column(0).to_pylist(), known)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.float64())], names=["value", "bits"])


def guess_costs(values: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(value, bits) of distinct ``values``, words costing what their share of all words of ``docs`` says."""
    texts = docs.select(F.lit("").alias("lang"), F.lit("").alias("source"), F.col(text_col).alias("text"))
    counts = stored(texts.mapInArrow(_count_rest, "lang string, source string, term binary, n long, docs long")
                    .groupBy(F.col("term").cast("string").alias("term"))
                    .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    known = (values.mapInArrow(_parts, "value string, word string")
             .join(counts.filter(F.col("docs") >= MIN_DOCS).withColumnRenamed("term", "word"), "word")
             .withColumn("bits", F.log2(F.lit(float(total)) / F.col("n")))
             .groupBy("value").agg(F.collect_list(F.struct("word", "bits")).alias("known")))
    return values.join(known, "value", "left").select("value", "known").mapInArrow(_guess, "value string, bits double")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_bits: float = MIN_BITS) -> DataFrame:
    """(id, base, spans): arrays of struct<start, kind, end[, bits]> in code points, by start, then kind."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    scanned = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _scan, f"id {docs.schema[id_col].dataType.simpleString()}, base array<struct<start:long,kind:int,end:long>>, "
               "found array<struct<start:long,end:long,value:string>>")
    rows = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    found = rows.select("row", F.explode("found").alias("v")).select("row", "v.*")
    costs = stored(guess_costs(found.select("value").distinct(), docs, text_col), "guess-costs").filter(
        F.col("bits") >= min_bits)
    hard = found.join(costs, "value").groupBy("row").agg(F.collect_list(F.struct(
        "start", F.lit(KINDS.index("guess")).alias("kind"), "end", "bits")).alias("hard"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                  F.lit(None).cast("double").alias("bits")))

    def named(spans):
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["kind"]).alias("kind"),
                                                     s["end"].alias("end"), s["bits"].alias("bits")))
    spans = F.sort_array(F.concat(base, F.coalesce("hard", F.array().cast(
        "array<struct<start:long,kind:int,end:long,bits:double>>"))))
    return (rows.join(hard, "row", "left")
            .select(F.col("id").alias(id_col), named(F.sort_array(base)).alias("base"), named(spans).alias("spans")))
