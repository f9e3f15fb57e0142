import math
import random
import textwrap

from pickwise.llm import licenses
from tests.llm import brute


def _want(text):
    words = brute.alnum_words(text)
    hits = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits += [(k, label) for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
    base, more, best = {x for _, x in hits}, set(), 0.0
    for line in (text or "").split("\n"):
        b = set(brute.alnum_words(line))
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(b & t) >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9):
                more.add(label)
                best = max(best, len(b & t) / len(t))
    return (len(words), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if hits else best)


CASES = [
    None, "", "...", "MIT License", "mit\nlicense", "mitlicense", "MIT licence", "the CC-BY cc by CC BY license",
    "apache license apache license mit license", "KGNU general public license gnu General PUBLIC License",
    "Licensed under CC BY-NC 4.0.", "Released under the MİT License", "é mit license ß",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance",
    "this work is licensed under", "x " * 40_000 + "mit license", "4 0 nc by cc under licensed",
]


def test_cases_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(CASES)],
                               "doc_id long, text string, id string, label int")
    for r in licenses.scan_licenses(df).collect():
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])
        assert got == _want(CASES[r["doc_id"]]), CASES[r["doc_id"]]


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0."), (1, "Licensed under CC BY-NC 4.0."),
                                (None, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    assert [r["labels"] for r in licenses.scan_licenses(df).collect()] == ["cc-by,cc-by-nc"] * 3
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def _found(text):
    words, labels, best = brute.alnum_words(text), set(), 0.0
    for label, template in licenses.TEMPLATES:
        t, size = set(template.split()), licenses.window_size(template)
        blocks = [brute.alnum_words(line) for line in text.split("\n")]
        blocks += [words[k:k + size] for k in range(0, len(words) if "\n" in text else 0, size // 2)]
        for b in map(set, blocks):
            if len(b & t) >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(b & t) / len(t))
    return labels, best


def test_wrapped_headers_are_found(spark):
    rng, docs, plain = random.Random(4), [], []
    for label, template in licenses.TEMPLATES:
        for width, mark in ((70, ""), (40, " * "), (30, "# "), (25, "dnl ")):
            for before in (0, 7, 59, 400):
                filler = [f"f{rng.randrange(999)}" for _ in range(before)]
                body = "\n".join(mark + x for x in textwrap.wrap(" ".join(filler + template.split() + ["tail"] * 9), width))
                docs.append(f"first line\n{body}\nlast line")
                plain.append(label)
    docs += ["one\ntwo", "\n\n", "released\nunder " + "x\n" * 400 + "the mit\nlicense",
             "released\nunder " + "x\n" * 20 + "the license"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert len(rows) == len(docs)
    for i, r in rows.items():
        labels, best = _found(docs[i])
        base = set(filter(None, r["base_labels"].split(",")))
        assert set(filter(None, r["labels"].split(","))) == labels | base, docs[i]
        assert r["score"] == (1.0 if r["n_base"] else best), docs[i]
        assert i >= len(plain) or plain[i] in labels, docs[i]


def test_texts_of_one_id_keep_labels_of_their_own(spark):
    rows = [(None, "released under the mit license"), (None, "hello world"), (7, "plain"), (7, "licensed under cc by nc 4 0"),
            (8, ""), (8, None), (8, "this work is licensed under a creative commons\nattribution 4 0 international license")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mark")
    got = sorted(((r["doc_id"], r["labels"], r["score"] > 0) for r in licenses.scan_licenses(df).collect()), key=str)
    assert got == sorted([(None, "mit", True), (None, "", False), (7, "", False), (7, "cc-by,cc-by-nc", True),
                          (8, "", False), (8, "", False), (8, "cc-by", True)], key=str)
