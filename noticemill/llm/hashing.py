"""Hashes of words and word sequences, in numpy."""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Word hashes that a task remembers.
REMEMBERED = 300_000


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 11)


class WordHashes(dict):
    """Hashes of the words seen; anew when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = word_hash(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    out = np.full(size, n, np.uint64)
    for i in range(n):
        out = (out * MULTIPLIER) + words[i : i + size]
    return mixed(out)


def leftmost_minima(values: np.ndarray, window: int) -> np.ndarray:
    """For each run of `window` values the place of its smallest, the leftmost of equal ones."""
    if len(values) < window:
        return np.zeros(0, np.int64)
    least, place, width = values, np.arange(len(values)), 1
    while width < window:
        step = min(width, window - width)  # runs of `width` twice, overlapping at the end
        size = len(least) - step
        right = least[step:] < least[:size]
        place = np.where(right, place[step:], place[:size])
        least = np.minimum(least[:size], least[step:])
        width += step
    return place
