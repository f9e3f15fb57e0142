"""Plain single-process versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: bytes | str) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def blank_words(text):
    return BLANK.findall((text or "").translate(LOWER))


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    w = blank_words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def minhash(docs, percent=85):
    """[(id, text)] -> {id: (n_shingles, component)}, links from this similarity on"""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[min(ids[a], ids[b]), max(ids[a], ids[b])] += 1
    groups = Sets()
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def vectors(rows, threshold=0.93):
    """[(id, vector, label)] -> {id: (n_links, component)}"""
    def good(v, label):
        return (v is not None and label is not None and len(v) and None not in v
                and all(math.isfinite(x) for x in v) and any(v))
    groups, links = Sets(), Counter()
    ok = [(i, v, c) for i, v, c in rows if good(v, c)]
    for k, (i, v, c) in enumerate(ok):
        for j, w, d in ok[:k]:
            if c == d and len(v) == len(w):
                top = math.fsum(x * y for x, y in zip(v, w))
                if top / (math.sqrt(math.fsum(x * x for x in v)) * math.sqrt(math.fsum(x * x for x in w))) >= threshold:
                    groups.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return {i: (links[i], groups.find(i)) for i, _, _ in rows}


def contamination(docs, items, window=13):
    """[(id, text)], [(item, text)] -> {id: (n_words, n_hit, item names)}"""
    grams = defaultdict(set)
    for name, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(str(name))
    out = {}
    for i, text in docs:
        w, hit, names = alnum_words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if found := grams.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    names |= found
        out[i] = len(w), len(hit), names
    return out


def repeats(docs, length=200):
    """[(id, text)] -> [(id, n_bytes, n_removed, n_spans, sha of the rest)]"""
    places = defaultdict(list)
    texts = [(i, (t or "").encode()) for i, t in docs]
    for d, (_, b) in enumerate(texts):
        for k in range(len(b) - length + 1):
            places[b[k:k + length]].append((d, k))
    gone = [bytearray(len(b)) for _, b in texts]
    for where in places.values():
        if len(where) > 1:
            for d, k in where:
                gone[d][k:k + length] = b"\1" * length
    out = []
    for (i, b), g in zip(texts, gone):
        spans = len(re.findall(rb"\x01+", bytes(g)))
        out.append((i, len(b), sum(g), spans, sha(bytes(x for x, y in zip(b, g) if not y))))
    return out


def sites_needed(sites):
    return max(3, math.ceil(len(set(sites)) * 6 / 10))


def spread(docs, min_sites):
    """[(id, text, site)] -> {id: (n_lines, n_removed, text)}; ids must differ."""
    sites, first = defaultdict(set), {}
    for i, text, site in sorted(docs, key=lambda r: r[0]):
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if key := line.strip(" \t\r"):
                sites[key].add(site)
                first.setdefault(key, (i, k))
    out = {}
    for i, text, _ in docs:
        if text is None:
            out[i] = 0, 0, None
            continue
        lines = text.split("\n")
        kept = [x for k, x in enumerate(lines)
                if not (key := x.strip(" \t\r")) or len(sites[key]) < min_sites or first[key] == (i, k)]
        out[i] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out
