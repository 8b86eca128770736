"""Word and shingle hashes inside Python tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

# Words a worker remembers; beyond that it forgets all and starts anew.
REMEMBERED = 1 << 16


class WordHashes(dict):
    """Word in UTF-8 -> its 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            self[word] = found
        return found


@lru_cache(maxsize=1)
def known() -> WordHashes:
    return WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in order. Bytes split at just the white space of the contracts: ASCII."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(known().__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; a shorter text has none."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x100000001B3) + words[i : i + count]
        total ^= total >> np.uint64(33)
    return mixed(total)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct shingles of a text. Fewer words than ``size`` make one shingle; no words make none."""
    words = word_hashes(text)
    if 0 < len(words) < size:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words, size))
