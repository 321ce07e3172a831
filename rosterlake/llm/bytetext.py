"""Whole texts as byte buffers in numpy: slices of a batch, words, hashes of words and of parts of words.

A batch is worked through in slices of about a megabyte, so memory follows the longest single text and not the
number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a hash over all its bits."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    return x ^ (x >> U64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=U64) * U64(_BASE)) | U64(1)
BLANK_BYTE = np.zeros(256, bool)
BLANK_BYTE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for at, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


@dataclass
class Slice:
    """Consecutive texts of a batch: rows first..last, their bytes and where each begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array | pa.ChunkedArray, most_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string array into slices; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Slice(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true bytes; a run never reaches into the next text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


class Hasher:
    """Hashes of any stretch of a slice, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        up, self._down = powers(self.size + 1)
        self._sum = np.zeros(self.size + 1, U64)
        np.cumsum(BYTE_CODES[data] * up[:self.size], out=self._sum[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sum[end] - self._sum[begin]) * self._down[begin]
