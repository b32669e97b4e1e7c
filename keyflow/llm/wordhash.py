"""Vectorised word hashing over the bytes of many texts.

Words are found with a 256-entry table that tells word bytes from separators;
a word's 64-bit hash is a polynomial over its bytes (each mapped through a fixed
random table), mixed at the end.  Hash equality stands for word equality: two
different words agree with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x + M3
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))
_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 32  # A-Z count as a-z
FOLDED = _BYTE[_FOLD]

#: Words are what lies between the bytes 0x20 and 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: Words are runs of ASCII letters and digits and of bytes beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(4095, BASE, np.uint64)]))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, BASE, np.uint64)]))
    return _powers


def hashed_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, prefix: int = 0):
    """Word hashes of texts ``data[offsets[i]:offsets[i + 1]]``.

    Returns (hashes, first), ``hashes[first[i]:first[i + 1]]`` being text i's
    words in order; with ``prefix`` also the hashes of the words' first so many bytes.
    """
    n_texts = len(offsets) - 1
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = data[lo:hi]
    offsets = offsets - lo
    inside = kind[data]
    if not inside.any():
        none = np.empty(0, np.uint64)
        return (none, np.zeros(n_texts + 1, np.int64), *([none] if prefix else []))
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = offsets[:-1][(offsets[:-1] < len(data))]
    start[edges] |= inside[edges]  # a text's first word never continues the text before
    starts = np.flatnonzero(start)
    owner = np.cumsum(start, dtype=np.int64)
    owner -= 1  # of each byte: the word that began last
    place = np.flatnonzero(inside)
    word = owner[place]
    at = place - starts[word]
    value = FOLDED[data[place]] * powers(int(at.max()) + 1)[at]
    bounds = np.searchsorted(word, np.arange(len(starts)))
    hashes = mix(np.add.reduceat(value, bounds))
    first = np.searchsorted(starts, offsets)
    if not prefix:
        return hashes, first
    value[at >= prefix] = 0
    return hashes, first, mix(np.add.reduceat(value, bounds) + np.uint64(7))


def pieces(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a (large) text column into runs of rows of about ``size`` bytes: (from, to, data, offsets)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b, data, offsets[a:b + 1]
        a = b
