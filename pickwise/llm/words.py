"""Words and word shingles of UTF-8 texts, hashed to 64 bits in numpy.

Texts arrive as bytes (a binary column), so nothing is decoded: ``bytes.lower``
lowers A-Z only and ``bytes.split`` cuts at exactly \\x20 and \\x09-\\x0D.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 400_000
# word separators of the alphanumeric cut become blanks, A-Z become a-z
ALNUM = bytes(32 if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
              else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.random.default_rng(20240917).integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def blank_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+``."""
    return text.lower().split()


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(ALNUM).split()


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; of fewer words, one for the whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(k, n)
    out = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        out += _mixed(hashes[j:n - size + 1 + j] * _ODD[j] + np.uint64(j)) * _ODD[(j + 3) % 8]
    return np.unique(_mixed(out))
