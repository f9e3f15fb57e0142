r"""License scans: phrase positions, and an exact set-similarity join against templates.

Texts are lower-cased in A-Z and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
Two things are found, both by built-in expressions only:

* *phrases*: every place where a phrase's words stand consecutively;
* *templates*: every text block that contains at least ``threshold`` of a
  template's distinct words. Blocks are the lines, and for headers wrapped over
  several lines, windows of consecutive words of the whole text. A template is
  looked for in windows of 16, 32, 64, ... words, the first at least twice its
  length; a window begins every half of one, so each run of up to half a window
  lies in one. A text of one line needs no windows.
  Words are ordered by their frequency in the corpus, rarest first. A block
  with |B| template words can only share the
  needed ``o`` of a template's |T| words if one of its first |B| - o + 1 words
  is among the template's first |T| - o + 1 (prefix filter), if |B| >= o
  (length filter), and if enough words are left behind the shared ones
  (positional filter); the survivors are counted in full. Words that occur in
  no template cannot be shared, so blocks are reduced to template words first,
  which changes no overlap.

Defined cases: a null text is empty; an empty text has no words and no labels;
a null id is matched like a value; rows with equal or null ids are told apart by
a digest of their texts, so no text gets the labels of another; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.storage import stored

# The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices and opening sentences of public licenses.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file "
               "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or "
            "neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms "
            "of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD = 0.8
_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lowered; no other letter may turn into an ASCII one.

    ``lower`` is far faster than ``translate``. Only U+212A and U+0130 lower to
    something with an ASCII letter; they are put out of the way as other
    non-ASCII letters, which keeps every word boundary and count.
    """
    out = F.replace(text, F.lit("K"), F.lit("ĸ"))
    return F.lower(F.replace(out, F.lit("İ"), F.lit("ı")))


def spaced(lowered: Column) -> Column:
    """Words with one blank on either side of each (two between words); '  ' if there are none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, _GAP, "  ")), F.lit(" "))


def _count(text: Column, part: str) -> Column:
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit(""))))
            / len(part)).cast("long")


def _n_words(words: Column) -> Column:
    return F.when(words == "  ", F.lit(0).cast("long")).otherwise(
        (_count(words, " ") / 2).cast("long"))


def phrase_scan(docs: DataFrame, id_col: str, text_col: str,
                phrases: dict[str, str] = PHRASES) -> DataFrame:
    """(id, mark, n_words, n_base, first_word, last_word, base array<string>) per row."""
    words = docs.select(F.col(id_col).alias("id"), text_mark(text_col).alias("mark"),
                        spaced(ascii_lower(F.coalesce(F.col(text_col), F.lit("")))).alias("w"))
    n_words, counts, firsts, lasts, labels = _n_words(F.col("w")), [], [], [], []
    for phrase, label in phrases.items():
        mark = " " + "  ".join(phrase.split()) + " "
        there = F.contains(F.col("w"), F.lit(mark))
        before = (_count(F.substring_index("w", mark, 1), " ") / 2).cast("long")
        behind = (_count(F.substring_index("w", mark, -1), " ") / 2).cast("long")
        counts.append(F.when(there, _count(F.col("w"), mark)).otherwise(F.lit(0)))
        firsts.append(F.when(there, before))
        lasts.append(F.when(there, n_words - behind - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return words.select(
        "id", "mark", n_words.alias("n_words"), sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"))


def text_mark(text_col: str) -> Column:
    """What tells texts of one id apart: a digest of 128 bits."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def _tokens(lowered) -> Column:
    return F.split(F.trim(F.regexp_replace(lowered, _GAP, " ")), " ")


def window_size(template: str) -> int:
    size = 16
    while size < 2 * len(template.split()):
        size *= 2
    return size


def template_matches(docs: DataFrame, id_col: str, text_col: str, templates=TEMPLATES,
                     threshold: float = THRESHOLD) -> DataFrame:
    """(id, mark, block, template, label, containment) of every block that reaches the threshold.

    Lines count up from 0, windows down from -1.
    """
    spark = docs.sparkSession
    sets = [(i, label, sorted(set(re.findall("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", text))))
            for i, (label, text) in enumerate(templates)]
    need = {i: math.ceil(threshold * len(words) - 1e-9) for i, _, words in sets}
    vocabulary = sorted({w for _, _, words in sets for w in words})
    lines = docs.select(F.col(id_col).alias("id"), text_mark(text_col).alias("mark"),
                        F.posexplode(F.split(ascii_lower(F.col(text_col)), "\n")).alias("block", "raw"))
    known = F.array(*map(F.lit, vocabulary))
    window = {i: window_size(text) for i, (_, text) in enumerate(templates)}
    # the words once per row, as a column of its own: inside the lambda they would be cut for every window
    flows = (docs.filter(F.contains(F.col(text_col), F.lit("\n")))
             .select(F.col(id_col).alias("id"), text_mark(text_col).alias("mark"), _tokens(ascii_lower(F.col(text_col))).alias("words")))

    def windows(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - size // 2 - 1), F.lit(size // 2))
        own = F.array(*map(F.lit, sorted({w for i, _, words in sets if window[i] == size for w in words})))
        return F.transform(starts, lambda k: F.struct(
            F.lit(size).alias("size"), F.array_intersect(F.slice("words", k + 1, size), own).alias("b")))
    passages = (flows.select("id", "mark", F.posexplode(F.concat(*map(windows, sorted(set(window.values()))))).alias("at", "w"))
                .select("id", "mark", (-1 - F.col("at")).alias("block"), "w.size", "w.b"))
    blocks = stored(
        lines.select("id", "mark", "block", F.lit(0).alias("size"), F.array_intersect(_tokens("raw"), known).alias("b"))
        .union(passages).filter(F.size("b") >= min(need.values())), "license-blocks")
    # at most one row per template word
    seen = {r["t"]: r["n"] for r in blocks.select(F.explode("b").alias("t"))
            .groupBy("t").agg(F.count("*").alias("n")).collect()}
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    rank = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, order[w])])
    ranked = blocks.select("id", "mark", "block", "size", F.array_sort(F.transform("b", lambda w: rank[w])).alias("b"))
    prefixes, whole = [], []
    for i, label, words in sets:
        ranks = sorted(order[w] for w in words)
        whole.append((i, label, need[i], ranks))
        prefixes += [(r, i, need[i], window[i], len(ranks), j) for j, r in enumerate(ranks[:len(ranks) - need[i] + 1])]
    wanted = F.array(*[F.lit(r) for r in sorted({p[0] for p in prefixes})])
    heads = (ranked.filter(F.arrays_overlap("b", wanted))
             .select("id", "mark", "block", "size", "b", F.size("b").alias("nb"), F.posexplode("b").alias("i", "rank")))
    prefix = F.broadcast(spark.createDataFrame(  # as long as the templates, not the data
        prefixes, "rank int, template int, need int, window int, nt int, j int"))
    candidates = (heads.join(prefix, "rank").filter((F.col("size") == 0) | (F.col("size") == F.col("window")))
                  .filter((F.col("nb") >= F.col("need")) & (F.col("i") <= F.col("nb") - F.col("need")))
                  .filter(F.least(F.col("nb") - F.col("i"), F.col("nt") - F.col("j"))
                          + F.least("i", "j") >= F.col("need")))
    full = F.broadcast(spark.createDataFrame(whole, "template int, label string, n int, t array<int>"))
    shared = F.size(F.array_intersect("b", "t"))
    return (candidates.select("id", "mark", "block", "b", "template").distinct()
            .join(full, "template").filter(shared >= F.col("n"))
            .select("id", "mark", "block", "template", "label", (shared / F.size("t")).alias("containment")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] = PHRASES, templates=TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Phrase counts and positions, base and all labels, and a score from 0 to 1 per row.

    The score is 1 where a phrase stands, else the best template containment
    that reached the threshold, else 0.
    """
    found = (template_matches(docs, id_col, text_col, templates, threshold)
             .groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")))
    base = phrase_scan(docs, id_col, text_col, phrases)
    out = base.join(found, base["id"].eqNullSafe(found["_id"]) & (base["mark"] == found["_mark"]), "left")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0),
                   F.coalesce("best", F.lit(0.0))).alias("score"))
