"""Words and word shingles of whole texts as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

MASK = (1 << 64) - 1
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(32)


class WordHashes(dict):
    """Memo of word -> 64-bit hash; emptied when it holds ``most`` words, so a task's memory
    is bounded whatever the vocabulary."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (bytes methods know ASCII only)."""
    return text.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> SHIFT)
    x = x * SPREAD
    x = x ^ (x >> SHIFT)
    x = x * SPREAD
    return x ^ (x >> SHIFT)


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in text order; none if there are fewer words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, size):
        out *= STEP
        out += h[i:i + n]
    return mix(out)


def shingle_set(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; with fewer words than ``size`` the whole sequence is one."""
    if not len(h):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(h, min(size, len(h))) + np.uint64(0 if len(h) >= size else len(h)))
