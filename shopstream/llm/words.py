"""Words and word shingles of whole blocks of texts, as numpy arrays of 64-bit hashes.

A word is a longest run of bytes other than ASCII white space; A-Z count as a-z. Equality of words and
shingles is decided on 64-bit hashes with fixed random parameters: two different ones among n
meet with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240229)
_BASE = int(_RANDOM.integers(0, 2**63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
# Value of each byte in a word's polynomial; white space adds nothing.
_VALUES = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES[SPACE] = 0


class Words(NamedTuple):
    """``start, end``: byte places in ``data``; ``first[i]:first[i + 1]``: the words of text ``i``."""

    data: np.ndarray
    text_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    value: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values in which every bit of the input matters to every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.ones(1 << bits, np.uint64)
    for b in range(bits):
        out[1 << b : 2 << b] = out[: 1 << b] * np.uint64(pow(base, 1 << b, 2**64))
    return out


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, max(20, int(n).bit_length()))[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each text starts plus the total); a null is empty."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> Words:
    data, text_start = raw(column)
    n = len(data)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = text_start[:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]  # a word ends with its text
    start = np.flatnonzero(begins)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(data, text_start, none, none, np.zeros(len(text_start), np.int64), np.zeros(0, np.uint64))
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = text_start[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    end = np.flatnonzero(ends) + 1
    sums = np.add.reduceat(_VALUES[data] * powers(_BASE, n), start)
    # Scaled back to the start of the word, so that its place does not matter.
    value = mix(sums * powers(_INVERSE, n)[start] + (end - start).astype(np.uint64))
    return Words(data, text_start, start, end, np.searchsorted(start, text_start), value)


def runs(value: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words, ignoring where texts end; ``len(value) - k + 1`` of them."""
    n = len(value) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + value[j : j + n]
    return mix(out)


def long_runs(value: np.ndarray, k: int) -> np.ndarray:
    """As ``runs`` for large ``k``, by differences of prefix sums of a polynomial; other values."""
    n = len(value) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * powers(_BASE, len(value)), dtype=np.uint64)])
    return mix((sums[k:] - sums[:-k]) * powers(_INVERSE, n))


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingles of each text; of a shorter text all words as one; of none, nothing."""
    every = runs(w.value, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            # The length goes in, so that a short text cannot equal a shingle.
            out.append(mix(runs(w.value[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
