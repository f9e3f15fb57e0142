"""Line dedup: lines that appear on many sites are boilerplate and go.

Every non-blank line (trimmed of blanks, tabs and carriage returns) is hashed
to 128 bits. One aggregation merges a HyperLogLog sketch of the sites per line
hash; lines whose estimate lies near the threshold get an exact distinct count,
the others are decided by the sketch. Of each line found on ``min_sites`` or
more sites only the first occurrence (smallest id, position, text hash) stays.

Defined cases: a null text has no lines and stays null, an empty text is one
blank line; blank lines are never counted or removed; a null site is a site of
its own; a null id sorts before others; rows with equal ids are told apart by their
texts, and equal rows share what is removed; an empty table gives no rows;
other columns pass through unchanged, except that ``n_lines`` and ``n_removed``
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.storage import stored

LG_K = 12  # 4096 registers: 1.6 % standard error
NEAR = 0.25  # estimates within this share of the threshold are counted exactly
SITE_SHARE, LEAST_SITES = 0.6, 3  # a line found on so large a part of the sites is boilerplate
BLANKS = " \t\r"
KEY = ["h1", "h2"]


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def sites_needed(docs: DataFrame, site_col: str = "source", share: float = SITE_SHARE, least: int = LEAST_SITES) -> int:
    """How many sites make a line boilerplate: a share of the distinct sites of ``docs``, ``least`` at least."""
    sites = docs.agg(F.count_distinct(F.coalesce(F.col(site_col).cast("string"), F.lit("\0")))).first()[0]
    return max(least, -(-sites * round(share * 100) // 100))


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(id, mark, pos, h1, h2, site) of every non-blank line; ``mark`` is the text's hash."""
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"),
                        F.coalesce(F.col(site_col).cast("string"), F.lit("\0")).alias("site"),
                        F.posexplode(F.split(text_col, "\n")).alias("pos", "raw"))
    line = _trimmed(F.col("raw"))
    return lines.filter(line != "").select(
        "id", "mark", "pos", "site", F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate_lines(rows: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2, first struct<id, pos, mark>) of lines on at least ``min_sites`` sites."""
    spread = stored(
        rows.groupBy(*KEY).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"),
            F.min(F.struct("id", "pos", "mark")).alias("first"))
        .filter(F.col("sites") >= (1 - NEAR) * min_sites), "line-spread")
    near = spread.filter(F.col("sites") <= (1 + NEAR) * min_sites).select(*KEY)
    exact = (rows.select(*KEY, "site").join(near, KEY, "left_semi")
             .groupBy(*KEY, "site").agg(F.lit(1).alias("one"))
             .groupBy(*KEY).agg(F.count("one").alias("n"))
             .filter(F.col("n") >= min_sites).select(*KEY))
    far = spread.filter(F.col("sites") > (1 + NEAR) * min_sites).select(*KEY)
    return stored(spread.select(*KEY, "first").join(exact.union(far), KEY, "left_semi"),
                  "boilerplate-lines")


def dedup_lines(docs: DataFrame, min_sites: int, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source") -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, plus ``n_lines`` and ``n_removed``."""
    docs = docs.drop("n_lines", "n_removed")
    rows = line_rows(docs, id_col, text_col, site_col)
    bad = boilerplate_lines(rows, min_sites)
    hits = (rows.join(bad, KEY)
            .filter(~(F.struct("id", "pos", "mark").eqNullSafe(F.col("first"))))
            .groupBy(F.col("id").alias("_cut_id"), F.col("mark").alias("_cut_mark"))
            .agg(F.collect_set("pos").alias("_cut")))
    out = docs.join(hits, docs[id_col].eqNullSafe(F.col("_cut_id"))
                    & (F.xxhash64(docs[text_col]) == F.col("_cut_mark")), "left")
    # split once per row, as a column of its own: inside the lambda it would be split for every line
    out = out.withColumn("_lines", F.split(F.col(text_col), "\n"))
    n_lines, cut = F.coalesce(F.size("_lines"), F.lit(0)), F.coalesce(F.col("_cut"), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), cut)
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    return out.select(
        *[F.when(F.size(cut) > 0, kept).otherwise(F.col(c)).alias(c) if c == text_col
          else F.col(c) for c in docs.columns],
        n_lines.cast("long").alias("n_lines"), F.size(cut).cast("long").alias("n_removed"))
