"""Word shingles of a text as sorted 64-bit hashes (numpy, whole texts).

Words are runs of characters outside ``\\x20\\x09-\\x0D`` after lower-casing
A-Z; a shingle is ``width`` consecutive words.  A text with fewer words is one
shingle of all its words; without words (or null) the set is empty.
"""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (fixed multipliers of a public 64-bit mixer)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Turns texts into shingle-hash sets; keeps a bounded word-hash cache."""

    def __init__(self, width: int = 5, cache_words: int = 400_000):
        self.width = width
        self.cache_words = cache_words
        self.cache: dict[bytes, int] = {}
        rng = np.random.Generator(np.random.PCG64(20240607))
        # One odd multiplier per word position, so order matters.
        self.mult = rng.integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def word_hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        cache = self.cache
        try:
            return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(cache) > self.cache_words:
                cache.clear()
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of the whole text."""
        w = self.word_hashes(text)
        if not len(w):
            return w
        k = min(self.width, len(w))
        n = len(w) - k + 1
        acc = np.full(n, k, np.uint64)
        for i in range(k):
            acc = acc + mix64(w[i:i + n]) * self.mult[i]
        return np.unique(mix64(acc))


def jaccard_parts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(intersection size, union size) of two sorted distinct arrays."""
    if not len(a) or not len(b):
        return 0, len(a) + len(b)
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    inter = int((a[at] == b).sum())
    return inter, len(a) + len(b) - inter
