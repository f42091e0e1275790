"""Sets of hashed word shingles, flat over a slice of documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from courierlens.llm.blocks import SpanHasher, lower_ascii, mixed, word_spans

WIDTH = 5
_HASHER = SpanHasher(0x5417)
_STEPS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


@dataclass
class Sets:
    """Sorted distinct 64-bit shingles of each row: ``values[bounds[i]:bounds[i + 1]]``."""

    values: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def row(self, i: int) -> np.ndarray:
        return self.values[self.bounds[i] : self.bounds[i + 1]]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Sets:
    """Distinct five-word shingles; a text with fewer words is one shingle, one without words none.

    Within a pair of documents equal shingles have equal hashes and different ones differ but
    for a chance of about n * n / 2**64.
    """
    data = lower_ascii(data)
    starts, ends, words = word_spans(data, offsets)
    hashes = _HASHER(data, starts, ends)
    count = np.diff(words)
    rows = len(count)
    # a short row is one shingle of all its words, marked by their number
    width = np.minimum(count, WIDTH)
    shingles = np.where(count > 0, np.maximum(count - WIDTH + 1, 1), 0)
    row = np.repeat(np.arange(rows), shingles)
    first = np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + words[:-1][row]
    value = width[row].astype(np.uint64)
    for k in range(WIDTH):
        inside = width[row] > k
        word = hashes[np.minimum(first + k, max(len(hashes) - 1, 0))] if len(hashes) else value
        value = np.where(inside, mixed(value * _STEPS[k % 4] + word), value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return Sets(value, np.searchsorted(row, np.arange(rows + 1)))


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for two sorted sets that are not empty."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(one) + len(other) - both)
