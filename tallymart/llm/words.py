"""Words and their 64-bit hashes for whole Arrow columns of text, in numpy.

A word is a longest run of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's hash is a
polynomial of its bytes, mixed, so it does not depend on the place of the word. Text is handled in
slices that end between words, so a very long text needs no more memory than its words do.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

SLICE = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (multiply and shift, three times)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of each text and the end); null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class WordHasher:
    def __init__(self) -> None:
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.inside = np.ones(256, bool)
        self.inside[[32, 9, 10, 11, 12, 13]] = False
        self.powers = self.inverses = np.ones(1, U64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, SLICE + 4096)
            for name, base in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _slices(self, breaks: np.ndarray, size: int):
        """(from, to) of about SLICE bytes each; every cut is at one of ``breaks``, where no word goes on."""
        lo = 0
        while lo < size:
            hi = min(size, lo + SLICE)
            if hi < size:
                k = np.searchsorted(breaks, hi, side="right")
                hi = breaks[k - 1] if k and breaks[k - 1] > lo else (breaks[k] if k < len(breaks) else size)
            yield int(lo), int(hi)
            lo = hi

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, row of each word), in reading order."""
        data, at = text_bytes(column)
        inside = self.inside[data]
        firsts = at[:-1][at[:-1] < len(data)]
        ends_word = ~inside
        ends_word[firsts] = True
        breaks = np.flatnonzero(ends_word)
        hashes, places = [], []
        for lo, hi in self._slices(breaks, len(data)):
            part = inside[lo:hi]
            cut = np.zeros(hi - lo + 1, bool)  # a text begins here
            cut[firsts[(firsts >= lo) & (firsts < hi)] - lo] = True
            cut[0] = cut[-1] = True
            starts = np.flatnonzero(part & (cut[:-1] | ~np.concatenate(([False], part[:-1]))))
            ends = np.flatnonzero(part & (cut[1:] | ~np.concatenate((part[1:], [False])))) + 1
            self._reach(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, U64)
            letters = self.lower[data[lo:hi]].astype(U64)
            np.cumsum((letters + U64(1)) * self.powers[: hi - lo], out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * self.inverses[starts]))
            places.append(starts + lo)
        if not hashes:
            return np.empty(0, U64), np.empty(0, np.int64)
        rows = np.searchsorted(at, np.concatenate(places), side="right") - 1
        return np.concatenate(hashes), rows


# Workers need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
