"""Words and five-word shingles of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers of the polynomial over word hashes, from a fixed rule.
FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(64)], dtype=np.uint64)
MOST_WORDS_KEPT = 400_000  # words remembered by a task, to bound its memory; results do not depend on it


class WordHashes(dict):
    """Hash of a word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MOST_WORDS_KEPT and len(word) < 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (shift-multiply rounds)."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive words, in order of their starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += hashes[i:i + n] * FACTORS[i]
    return mixed(total)


def shingle_set(text: str | None, words: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes: words parted by ASCII blanks, A-Z lower-cased.

    Fewer words than a shingle count as one; no words give an empty set.
    """
    split = text.encode().lower().split() if text else []
    if not split:
        return np.zeros(0, dtype=np.uint64)
    hashes = words.of(split)
    return np.unique(runs(hashes, min(size, len(split))))
