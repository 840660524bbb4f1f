"""Elias-Fano sequences: monotone numbers in two bits each plus the bits that the universe needs.

The low bits lie side by side; the high part of the i-th value sets bit ``high + i`` of a bit row.
Counting bits in that row finds a value by its place, and the places by a value's high part.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER = 4


def _place_in_byte() -> np.ndarray:
    """For a byte and a number k, the place of its k-th set bit."""
    table = np.zeros((256, 8), np.int64)
    for byte in range(256):
        set_bits = [i for i in range(8) if byte >> i & 1]
        table[byte, : len(set_bits)] = set_bits
    return table


def encode(values: np.ndarray, universe: int) -> bytes:
    """Non-falling values below the universe, as bytes."""
    n = len(values)
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    length = (universe >> low) + n + 1
    row = np.zeros(-(-length // 64) * 64, np.uint8)
    row[high] = 1
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    # Eight spare bytes let the last value be read as a whole word.
    lows = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes() + bytes(8)
    lows += bytes(-len(lows) % 8)
    highs = np.packbits(row, bitorder="little").tobytes()
    header = np.array([n, low, len(lows), len(highs)], np.int64)
    return header.tobytes() + lows + highs


class Sequence:
    """Reads an encoded sequence out of any buffer, memory-mapped ones too."""

    def __init__(self, buffer: np.ndarray):
        header = buffer[: 8 * HEADER].view(np.int64)
        self.n, self.low, lows, highs = (int(x) for x in header)
        first = 8 * HEADER
        self.lows = buffer[first : first + lows]
        self.words = buffer[first + lows : first + lows + highs].view(np.uint64)
        self.size = first + lows + highs
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ones_before = np.concatenate([[0], np.cumsum(ones)])
        self.zeros_before = np.concatenate([[0], np.cumsum(64 - ones)])
        self.place = _place_in_byte()

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th set (or, flipped, unset) bit of the high row, from 0."""
        word = np.searchsorted(before, k, "right") - 1
        rest = k - before[word]
        bits = self.words[word]
        bits = (~bits if flip else bits).copy()
        at = word * 64
        todo = np.ones(len(k), bool)
        for _ in range(8):
            byte = (bits & np.uint64(255)).astype(np.int64)
            here = np.bitwise_count(byte.astype(np.uint8)).astype(np.int64)
            hit = todo & (rest < here)
            at[hit] += self.place[byte[hit], rest[hit]]
            todo &= ~hit
            at[todo] += 8
            rest = np.where(todo, rest - here, rest)
            bits >>= np.uint64(8)
        return at

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        first = i * self.low
        byte = first >> 3
        word = np.zeros(len(i), np.uint64)
        for k in range(8):
            word |= self.lows[byte + k].astype(np.uint64) << np.uint64(8 * k)
        word >>= (first & 7).astype(np.uint64)
        return word & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at these places; low parts may have up to 57 bits."""
        high = (self._select(i, self.ones_before, False) - i).astype(np.uint64)
        return high << np.uint64(self.low) | self.low_bits(i)

    def find(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Place of each value within its range of places ``first .. last-1``, or -1.

        The successor search: the first place whose value is not below, by halving the range that
        the value's high part leaves.
        """
        if not len(values) or not self.n:
            return np.full(len(values), -1, np.int64)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low)).astype(np.int64)
        wanted = values & np.uint64((1 << self.low) - 1)
        start = np.zeros(len(values), np.int64)
        later = high > 0
        start[later] = self._select(high[later] - 1, self.zeros_before, True) - (high[later] - 1)
        end = self._select(high, self.zeros_before, True) - high
        low, stop = np.maximum(start, first), np.minimum(end, last)
        above = stop.copy()
        while (open_ := low < above).any():
            middle = (low + above) >> 1
            less = np.zeros(len(values), bool)
            less[open_] = self.low_bits(middle[open_]) < wanted[open_]
            low = np.where(open_ & less, middle + 1, low)
            above = np.where(open_ & ~less, middle, above)
        out = np.full(len(values), -1, np.int64)
        inside = np.flatnonzero(low < stop)
        same = self.low_bits(low[inside]) == wanted[inside]
        out[inside[same]] = low[inside[same]]
        return out
