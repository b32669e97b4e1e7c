"""Sets of word shingles as sorted 64-bit hashes, the hashes that identify a set, and sketches that bound differences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from keyflow.llm.wordhash import SPACED, hashed_words, mix, pieces

_WEIGHT = mix(np.arange(64, dtype=np.uint64) + np.uint64(1000)) | np.uint64(1)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words has its whole sequence as its only shingle, a text
    without words an empty set.  A-Z are lower-cased; words lie between the
    characters 0x20 and 0x09-0x0D.
    """
    for _, _, data, offsets in pieces(column):
        words, first = hashed_words(data, offsets, SPACED)
        runs = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for j in range(width):
            runs += words[j:j + len(runs)] * _WEIGHT[j]
        runs = mix(runs)
        cuts = first.tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= width:
                some = np.sort(runs[a:b - width + 1])
                yield some[np.concatenate([[True], some[1:] != some[:-1]])]
            elif b > a:
                yield mix(np.array([(words[a:b] * _WEIGHT[:b - a]).sum() + np.uint64(b - a)], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def set_key(elements: np.ndarray) -> int:
    """A signed 64-bit number that stands for the whole set; equal sets have equal keys."""
    total = mix(elements ^ np.uint64(0x51AF)).sum(dtype=np.uint64) + np.uint64(len(elements))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def parity_sketch(elements: np.ndarray) -> bytes:
    """One parity bit for each of two to four times as many cells as there are elements.

    The number of bits in which two sketches differ never exceeds the size of
    the sets' symmetric difference.  Sketches of different lengths are folded.
    """
    bits = max(64, 2 << int(len(elements)).bit_length())
    cell = np.bincount((mix(elements ^ np.uint64(0x0DD5)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((cell & 1).astype(np.uint8), bitorder="little").tobytes()


class Sketch:
    """A parity sketch as one whole number, folded to other lengths when they are asked for."""

    __slots__ = ("bits", "folded")

    def __init__(self, sketch: bytes):
        self.bits = 8 * len(sketch)
        self.folded = {self.bits: int.from_bytes(sketch, "little")}

    def at(self, bits: int) -> int:
        found = self.folded.get(bits)
        if found is None:
            wider = self.at(2 * bits)
            found = self.folded[bits] = (wider >> bits) ^ (wider & ((1 << bits) - 1))
        return found

    def difference(self, other: Sketch) -> int:
        """Lower bound of the symmetric difference of the two sets."""
        bits = min(self.bits, other.bits)
        return (self.at(bits) ^ other.at(bits)).bit_count()


def sketch_difference(a: bytes, b: bytes) -> int:
    return Sketch(a).difference(Sketch(b))
