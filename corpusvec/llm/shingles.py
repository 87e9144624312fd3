"""Word shingles of texts as sets of 64-bit hashes."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

from corpusvec.llm.common import held, words_of

#: Distinct words whose hashes a worker keeps before it starts anew.
MEMO = 1 << 18


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def word_hashes() -> WordHashes:
    return held("word-hashes", None, WordHashes)


@functools.lru_cache(maxsize=8)
def multipliers(width: int) -> np.ndarray:
    return np.random.default_rng(width).integers(1, 1 << 63, size=width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words.

    A text of fewer words is one run of all it has; one without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    runs = len(words) - width + 1
    total = np.full(runs, width, dtype=np.uint64)
    for k, by in enumerate(multipliers(width)):
        total += hashes[k : k + runs] * by
    return np.unique(mixed(total))
