"""Elias-Fano lists of rising numbers, in numpy, over arrays that may be memory-mapped.

The low bits of every number are packed side by side; the high bits are one bit vector in which number i
sets bit high(i) + i. Reading number i is a select on that vector.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

U64 = np.uint64
STEP = 64  # one select sample per so many numbers


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The numbers' lowest ``width`` bits, side by side, in 64-bit words with one to spare."""
    words = np.zeros(len(values) * width // 64 + 2, U64)
    if not width or not len(values):
        return words
    mask = U64((1 << width) - 1)
    at = np.arange(len(values), dtype=np.int64) * width
    cell, shift = at >> 6, (at & 63).astype(U64)
    low = (values & mask) << shift
    # Numbers that begin in one word do not overlap, so their sum is their union.
    heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    words[cell[heads]] = np.bitwise_or.reduceat(low, heads)
    over = (at & 63) + width > 64
    words[cell[over] + 1] |= (values[over] & mask) >> (U64(64) - shift[over])
    return words


@dataclass
class EliasFano:
    size: int
    width: int  # low bits
    low: np.ndarray
    high: np.ndarray  # the bit vector, as 64-bit words
    samples: np.ndarray  # word that holds number k * STEP, and the numbers before that word

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values`` must not fall."""
        values = np.asarray(values, U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max((top // max(n, 1)).bit_length() - 1, 0)
        place = (values >> U64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(place[-1]) >> 6) + 1 if n else 1, U64)
        cell = place >> 6
        heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if n else np.empty(0, np.int64)
        if n:
            high[cell[heads]] = np.bitwise_or.reduceat(U64(1) << (place & 63).astype(U64), heads)
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        words = cell[::STEP]
        return cls(n, width, pack_bits(values, width), high, np.stack((words, before[words])) if n else np.zeros((2, 1), np.int64))

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.samples]

    def at(self, index: np.ndarray) -> np.ndarray:
        """The numbers at ``index``."""
        index = np.asarray(index, np.int64)
        sample = index // STEP
        word, before = self.samples[0][sample].copy(), self.samples[1][sample]
        rank = index - before  # set bits to pass from the start of ``word``
        here = np.bitwise_count(self.high[word]).astype(np.int64)
        todo = np.flatnonzero(rank >= here)
        while len(todo):
            rank[todo] -= here[todo]
            word[todo] += 1
            here[todo] = np.bitwise_count(self.high[word[todo]])
            todo = todo[rank[todo] >= here[todo]]
        bits, bit = self.high[word], np.zeros(len(index), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            lower = np.bitwise_count(bits & U64((1 << half) - 1)).astype(np.int64)
            up = rank >= lower
            rank -= np.where(up, lower, 0)
            bit += np.where(up, half, 0)
            bits = np.where(up, bits >> U64(half), bits)
        value = ((word * 64 + bit - index).astype(U64)) << U64(self.width)
        if self.width:
            at = index * self.width
            cell, shift = at >> 6, (at & 63).astype(U64)
            low = self.low[cell] >> shift
            over = (at & 63) + self.width > 64
            low = np.where(over, low | (self.low[cell + 1] << ((U64(64) - shift) & U64(63))), low)
            value |= low & U64((1 << self.width) - 1)
        return value

    def successor(self, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each query, the first index from ``lo`` on (below ``hi``, else ``hi``) whose number is at
        least ``value``: a search within the queries' own ranges."""
        lo, hi = np.array(lo, np.int64), np.array(hi, np.int64)
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            middle = (lo[todo] + hi[todo]) >> 1
            less = self.at(middle) < value[todo]
            lo[todo[less]] = middle[less] + 1
            hi[todo[~less]] = middle[~less]
            todo = todo[lo[todo] < hi[todo]]
        return lo


cloudpickle.register_pickle_by_value(sys.modules[__name__])
