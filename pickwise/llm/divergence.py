"""Source divergence audit: how far each source's terms depart from its siblings' and its language's.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. A language
keeps the terms of at least ``MIN_DOCS`` of its documents (V of them). A group
(language, source) gives a kept term p = 1 + floor(10^9 (count + 1) / (N + V)),
N its occurrences of kept terms, and departs from a reference q by
f(p, q) = floor((p - q)^2 / q).

Everything is ranked by count cells. p depends on a count alone, so terms with
equal (group count, language count) form a cell: f is evaluated once per cell,
cells of equal value merge, values are ranked by the cumulative number of their
terms, and only the cells within the wanted ranks are expanded to terms, in
UTF-8 order. The sum of f over all V terms for two sources is taken apart: a
term absent from both counts through V, a term of one through that group's
cells of equal counts, and only terms that both hold need their common counts.
Those come as profiles (the counts of a term over a block of sources; equal
profiles merge with their multiplicity), from which numpy adds to one matrix
per pair of source blocks, so no pairs of sources are spelled out per term.

Words are counted in Python, with a bounded dictionary that is flushed to
Spark's aggregation; p is exact in decimals, f in longs (its numerator is at
most 10^18).

Defined cases: null text, lang and source count as ''; a text without terms
still makes its group occur; a language without kept terms gives its pairs the
value 0 and no terms; equal rows are documents of their own; a lone source has
no pairs; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.storage import stored

MIN_DOCS, TOP = 3, 200
UNIT = 1_000_000_000
HELD_TERMS = 500_000  # distinct terms a task holds before it hands them on, about 100 MB
SOURCE_BLOCK = 128  # sources whose counts stand in one profile
PAIR_CHUNK = 1 << 20  # products of two profiles evaluated together
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
GROUP = ["lang", "source"]


def count_words(batches):
    """(lang, source, text as bytes) -> (lang, source, term, n, docs), partial sums."""
    one_doc = 1 << 40  # both counts of a term in one number: occurrences below, documents above
    held: dict = {}
    size = 0

    def flush():
        for (lang, source), terms in held.items():
            names, sums = list(terms), np.fromiter(terms.values(), np.int64, len(terms))
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                some = sums[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(part)), pa.repeat(pa.scalar(source, pa.string()), len(part)),
                     pa.array(part, pa.binary()), pa.array(some % one_doc), pa.array(some // one_doc)],
                    names=["lang", "source", "term", "n", "docs"])
    for batch in batches:
        langs, sources, texts = (batch.column(c) for c in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            if (lang, source) not in held:
                size += 1
            terms = held.setdefault((lang, source), {})
            before, get = len(terms), terms.get
            for term, n in Counter(text.as_py().translate(LETTERS).split()).items():
                terms[term] = get(term, 0) + n + one_doc
            size += len(terms) - before
            if size > HELD_TERMS:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group."""
    rows = docs.select(_plain(lang_col).alias("lang"), _plain(source_col).alias("source"),
                       _plain(text_col).cast("binary").alias("text"))
    return (rows.mapInArrow(count_words, "lang string, source string, term binary, n long, docs long")
            .groupBy(*GROUP, F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _plain(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _share(count: str, total: str, v: str) -> Column:
    """1 + floor(10^9 (count + 1) / (total + v)), exact; null where there is nothing to share."""
    return _share_of(F.col(count), F.col(total), F.col(v))


def _share_of(count: Column, total: Column, v: Column) -> Column:
    whole = total + v
    # below 9 * 10^9 occurrences the numerator is a long, beyond that a decimal
    small = F.call_function("div", (count + 1) * F.lit(UNIT), whole)
    large = F.call_function("div", (count.cast("decimal(19,0)") + 1) * F.lit(UNIT).cast("decimal(10,0)"), whole.cast("decimal(19,0)"))
    return F.when(whole == 0, F.lit(None)).when(count < F.lit(9_000_000_000), 1 + small).otherwise(1 + large)


def _f(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _total(value: str | Column) -> Column:
    return F.sum((F.col(value) if isinstance(value, str) else value).cast("decimal(38,0)"))


def _common(batches):
    """Profiles of two source blocks -> per pair of sources, what terms of both add to the one-sided sums."""
    sums: dict = {}

    def f(p, q):
        return (p - q) * (p - q) // q

    def emit():
        for (lang, i, j), m in sums.items():
            a, b = np.nonzero(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(a + i * SOURCE_BLOCK), pa.array(b + j * SOURCE_BLOCK),
                 pa.array(m[a, b])], names=["lang", "a", "b", "part"])

    def add(key, a, b, mult):
        """Sources of profile ``a`` as groups, of ``b`` as items; one row per place in each."""
        (at, p, p0), (bt, q, q0) = a, b
        m = sums.setdefault(key, np.zeros((SOURCE_BLOCK, SOURCE_BLOCK), np.int64))
        more = f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
        np.add.at(m, (at % SOURCE_BLOCK, bt % SOURCE_BLOCK), more * mult)

    for batch in batches:
        keys = list(zip(batch.column("lang").to_pylist(), batch.column("i").to_pylist(), batch.column("j").to_pylist()))
        mult = batch.column("terms").to_numpy()
        sides = []
        for name in ("left", "right"):
            column = batch.column(name)
            parts = column.flatten()
            sides.append((column.value_lengths().to_numpy(), [parts.field(k).to_numpy() for k in ("idx", "p", "p0")]))
        (na, a), (nb, b) = sides
        a0, b0, work = np.cumsum(na) - na, np.cumsum(nb) - nb, na.astype(np.int64) * nb
        runs = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]] + [len(keys)]
        for start, stop in zip(runs, runs[1:]):
            pieces = np.cumsum(work[start:stop]) // PAIR_CHUNK
            for piece in np.unique(pieces):
                rows = start + np.flatnonzero(pieces == piece)
                each = work[rows]
                row = np.repeat(rows, each)
                place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                x, y = a0[row] + place // nb[row], b0[row] + place % nb[row]
                lang, i, j = keys[start]
                left, right = [c[x] for c in a], [c[y] for c in b]
                add((lang, i, j), left, right, mult[row])
                if i != j:
                    add((lang, j, i), right, left, mult[row])
        if len(sums) > 64:
            yield from emit()
            sums = {}
    yield from emit()


def _profiles(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, left, right, terms): how many terms have these shares over two source blocks, i <= j."""
    blocks = groups.groupBy("lang").agg((F.expr(f"max(idx) div {SOURCE_BLOCK}") + 1).cast("int").alias("blocks"))
    if (blocks.agg(F.max("blocks")).first()[0] or 1) == 1:  # every block is a whole language: it meets itself only
        units = shares.select("lang", F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("part").alias("left"),
                              F.col("part").alias("right"))
    else:
        i, j = F.least("blk", "other"), F.greatest("blk", "other")
        units = (shares.join(blocks, "lang").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .groupBy("lang", "term", i.alias("i"), j.alias("j"))
                 .agg(F.max(F.when(F.col("blk") == i, F.col("part"))).alias("left"),
                      F.max(F.when(F.col("blk") == j, F.col("part"))).alias("right")))
    return (units.filter("left is not null and right is not null and (i <> j or size(left) > 1)")
            .groupBy("lang", "i", "j", "left", "right").agg(F.count("*").alias("terms")))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of f over all kept terms for every two sources of a language."""
    both = (_profiles(shares, groups).mapInArrow(_common, "lang string, a long, b long, part long").filter("a <> b")
            .groupBy("lang", "a", "b").agg(_total("part").alias("part")))

    cells = (shares.select("lang", F.explode("part").alias("s")).select("lang", "s.*")
             .groupBy("lang", "idx", "p", "p0").agg(F.count("*").alias("terms")))
    other = groups.select("lang", F.col("idx").alias("o"), F.col("p0").alias("o0"))
    sided = cells.join(other, "lang").filter("idx <> o").groupBy("lang", "idx", "o").agg(
        _total((_f("p", "o0") - _f("p0", "o0")) * F.col("terms")).alias("as_group"),
        _total((_f("o0", "p") - _f("o0", "p0")) * F.col("terms")).alias("as_item"))
    sided = sided.select("lang", F.explode(F.array(
        F.struct(F.col("idx").alias("a"), F.col("o").alias("b"), F.col("as_group").alias("part")),
        F.struct(F.col("o").alias("a"), F.col("idx").alias("b"), F.col("as_item").alias("part")))).alias("s")).select("lang", "s.*")
    every = groups.select("lang", F.col("idx").alias("a"), "source", "v", "p0").join(
        groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"), F.col("p0").alias("q0")), "lang").filter(
        "a <> b")
    added = both.unionByName(sided).groupBy("lang", "a", "b").agg(_total("part").alias("part"))
    return (every.join(added, ["lang", "a", "b"], "left")
            .select("lang", "source", "item",
                    (F.coalesce("part", F.lit(0)) + F.coalesce(_f("p0", "q0") * F.col("v"), F.lit(0))).cast("long").alias("value")))


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): a group's terms above their language's share, to rank ``top``."""
    each = kept.select("lang", "term", "lang_n", F.explode("part").alias("s")).select("lang", "term", "lang_n", "s.idx", "s.n")
    key = ["lang", "idx"]
    cells = (each.groupBy(*key, "n", "lang_n").agg(F.count("*").alias("terms"))
             .join(groups.select(*key, "total", "lang_total", "v"), key)
             # p > q needs (n + 1) / (total + v) > (lang_n + 1) / (lang_total + v); doubles leave a margin
             .filter((F.col("n") + 1.0) / (F.col("total") + F.col("v"))
                     > (F.col("lang_n") + 1.0) / (F.col("lang_total") + F.col("v")) * (1 - 1e-12))
             .withColumn("p", _share("n", "total", "v")).withColumn("q", _share("lang_n", "lang_total", "v"))
             .filter("p > q").withColumn("value", _f("p", "q")).select(*key, "n", "lang_n", "terms", "value"))
    by_value = Window.partitionBy(*key).orderBy(F.desc("value"))
    values = (cells.groupBy(*key, "value").agg(F.sum("terms").alias("terms"))
              .withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= top)
              .withColumn("before", F.sum("terms").over(by_value.rowsBetween(Window.unboundedPreceding, 0)) - F.col("terms"))
              .filter(F.col("before") < top).select(*key, "value", "before"))
    wanted = cells.join(values, [*key, "value"]).select(*key, "n", "lang_n", "value", "before")
    within = Window.partitionBy(*key, "value").orderBy("term")
    return (each.join(wanted, [*key, "n", "lang_n"])
            .withColumn("nth", F.row_number().over(within)).filter(F.col("nth") <= top)
            .withColumn("rank", (F.col("before") + F.col("nth")).cast("int")).filter(F.col("rank") <= top)
            .join(groups.select(*key, "source"), key)
            .select(*GROUP, F.col("term").alias("item"), "value", "rank"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank); part 'pair' compares sources, 'term' lists a source's own terms."""
    lang = Window.partitionBy("lang")
    numbers = stored(docs.select(_plain(lang_col).alias("lang"), _plain(source_col).alias("source")).distinct()
                     .withColumn("idx", (F.row_number().over(lang.orderBy("source")) - 1).cast("long"))
                     .withColumn("blk", F.expr(f"idx div {SOURCE_BLOCK}").cast("int")), "term-sources")
    # a term's counts over a block of sources stand in one row; the sums over its blocks need no further exchange
    same = Window.partitionBy("lang", "term")
    kept = (term_counts(docs, text_col, lang_col, source_col).join(numbers, GROUP)
            .repartition("lang", "term").groupBy("lang", "term", "blk")
            .agg(F.sort_array(F.collect_list(F.struct("idx", "n"))).alias("part"), F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = stored(kept.withColumn("lang_docs", F.sum("docs").over(same)).withColumn("lang_n", F.sum("n").over(same))
                  .withColumn("first", F.col("blk") == F.min("blk").over(same))
                  .filter(F.col("lang_docs") >= min_docs).select("lang", "term", "blk", "part", "lang_n", "first"), "kept-terms")
    sums = (kept.select("lang", F.explode("part").alias("s")).groupBy("lang", F.col("s.idx").alias("idx"))
            .agg(F.sum("s.n").alias("total")))
    langs = kept.filter("first").groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = stored(numbers.join(sums, ["lang", "idx"], "left").join(langs, "lang", "left")
                    .na.fill(0, ["total", "v", "lang_total"])
                    .withColumn("zero", F.lit(0)).withColumn("p0", _share("zero", "total", "v"))
                    .select(*GROUP, "idx", "blk", "total", "v", "lang_total", "p0"), "term-groups")
    # the totals of a block, at most SOURCE_BLOCK of them, in the order of the sources
    totals = groups.groupBy("lang", "blk").agg(
        F.sort_array(F.collect_list(F.struct("idx", "total", "p0"))).alias("own"), F.max("v").alias("v"))
    shares = kept.join(totals, ["lang", "blk"]).select("lang", "term", "blk", F.transform("part", lambda s: F.struct(
        s["idx"].alias("idx"),
        _share_of(s["n"], F.get(F.col("own"), (s["idx"] % SOURCE_BLOCK).cast("int"))["total"], F.col("v")).alias("p"),
        F.get(F.col("own"), (s["idx"] % SOURCE_BLOCK).cast("int"))["p0"].alias("p0"))).alias("part"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    pairs = _pairs(shares, groups).withColumn("rank", F.row_number().over(order))
    columns = [*GROUP, "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .union(_terms(kept, groups, top).withColumn("part", F.lit("term")).select(*columns)))
