"""Words and word shingles of whole texts as 64-bit hashes, for code that runs in workers."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from wordloom.llm.common import worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words whose hashes a worker remembers.
REMEMBERED = 200_000
# Sets texts that are one short shingle apart from shingles of full width.
LONE = 0x9E3779B97F4A7C15


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z lower-cased."""
    cache = worker_cache("words")
    known = cache.get("hashes")
    if known is None:
        known = cache["hashes"] = Hashes()
    words = text.encode().lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words; a text with fewer words is one
    shingle as a whole, one without words has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < width:
        words, width = words ^ np.uint64(LONE * len(words) & (1 << 64) - 1), len(words)
    last = len(words) - width
    joined = words[width - 1 :]
    for place in range(width - 2, -1, -1):
        joined = words[place : place + last + 1] + mixed(joined)
    return np.unique(mixed(joined))
