"""Words and word shingles of texts as 64-bit hashes, inside tasks."""
from __future__ import annotations

import numpy as np
import xxhash

#: Fixed value: words of a shingle.
WIDTH = 5
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[1]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[2]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Maps a word (bytes) to its hash; holds at most ``bound`` words."""

    def __init__(self, bound: int = 600_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of ``text``, A-Z in lower case; words end at space and at characters 9 to 13."""
        words = text.encode("utf-8", "replace").lower().split() if text else []
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the five-word shingles; with fewer words, of the whole sequence; without words, none."""
        w = self.of(text)
        if not len(w):
            return w
        n = max(1, len(w) - WIDTH + 1)
        h = np.full(n, np.uint64(min(len(w), WIDTH)), dtype=np.uint64)
        for k in range(min(len(w), WIDTH)):
            h = mixed(h * _MIX[0] + w[k:k + n])
        return np.unique(h)
