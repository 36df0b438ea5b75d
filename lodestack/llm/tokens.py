"""Words of texts as 64-bit numbers, and hashes of runs of symbols."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)


class WordNumbers(dict):
    """Number of a word (bytes); words are remembered until there are too many."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.MOST:
            self.clear()
        out = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters."""
    return text.split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(numbers: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n numbers."""
    if len(numbers) < n:
        return np.zeros(0, np.uint64)
    out = numbers[: len(numbers) - n + 1].copy()
    for k in range(1, n):
        out = out * BASE + numbers[k : len(numbers) - n + 1 + k]
    return mixed(out)
