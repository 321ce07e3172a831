"""Sets of hashed word n-grams of whole texts, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .bytetext import BLANK_BYTE, LOWERED, U64, Hasher, Slice, mixed, runs

_PLACES = mixed(np.arange(11, 75, dtype=U64)) | U64(1)
BINS_PER = 8


@dataclass
class Sets:
    """Distinct shingles of the texts of a slice in ascending order, grouped by text."""

    hashes: np.ndarray
    offsets: np.ndarray
    signatures: np.ndarray

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.offsets[row]:self.offsets[row + 1]]


def _grouped(row: np.ndarray, rows: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])


def shingle_sets(part: Slice, n: int) -> Sets:
    """Sets of ``n``-word shingles of lower-cased (A-Z) texts; a shorter text is one shingle of all its words.

    Words and shingles are 64-bit hashes; a signature is a hash of the whole set, the same for equal sets.
    """
    data = LOWERED[part.data]
    begin, end = runs(~BLANK_BYTE[data], part.offsets)
    word = mixed(Hasher(data)(begin, end))
    first = np.searchsorted(begin, part.offsets)
    rows = len(part.offsets) - 1
    count = np.diff(first)
    shingles = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(rows), shingles)
    at = np.repeat(first[:-1] - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
    stop = first[1:][row]
    value = np.zeros(len(at), U64)
    padded = np.concatenate([word, np.zeros(n, U64)])
    for k in range(n):
        value += np.where(at + k < stop, padded[at + k] * _PLACES[k % len(_PLACES)] + U64(k // len(_PLACES)), U64(0))
    value = mixed(value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    if len(value):
        fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])
        value, row = value[fresh], row[fresh]
    offsets = _grouped(row, rows)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(value), dtype=U64)])
    signatures = mixed(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(U64))
    return Sets(value, offsets, signatures.view(np.int64))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def histogram(values: np.ndarray) -> bytes:
    """Counts of a set per equal range of hashes; about one range per eight members, a power of two."""
    bits = max(0, (len(values) // BINS_PER).bit_length() - 1)
    if not bits:
        return np.array([len(values)], np.uint16).tobytes()
    counts = np.bincount((values >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 65535).astype(np.uint16).tobytes()


def difference_bound(a: bytes, b: bytes) -> int:
    """Least size of the symmetric difference of two sets, from their histograms.

    Members in different ranges differ, so the counts of a range differ by members without a partner.
    """
    x, y = np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.uint16).astype(np.int64)
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(1)
    return int(np.abs(x - y).sum())
