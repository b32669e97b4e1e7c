"""PartEnum signatures for sets with a Jaccard similarity of at least num/den (default 75/100).

Two sets A and B with ``den * |A & B| >= num * |A | B|`` differ in at most
``k = (den - num) * (|A| + |B|) / (den + num)`` elements.  Sets are put into bands of size
[2^i, 2^(i+1)); a pair lies in one band or in two neighbours, so a set takes
part in the instance of its own band, and in the next one if a partner there
can exist.  In an instance the feature domain (hashed elements) is cut into n1
first-level parts of ``N2`` second-level parts each, and for every first-level
part all subsets of ``N2 - K2`` second-level parts are enumerated; the
contents of a subset are one signature.

With n1 > k / (K2 + 1), some first-level part holds at most K2 differences, so
the sets agree on one of its subsets.  A set emits the non-empty subsets of its
parts in order up to the q-th good one, q = floor(k_A / (K2 + 1)) + 1, where a
part is good if more than K2 of its second-level parts are non-empty (then each
subset is).  Among its first q good parts one has at most K2 differences; if the
partner stops before it, the same argument from the partner's side gives an
earlier common one.  A set with fewer than q good parts emits all it has and
also each element, which finds partners that are short of good parts too.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from keyflow.llm.wordhash import mix

N2, K2 = 3, 1
SUBSETS = list(combinations(range(N2), N2 - K2))


def most_partner(size: int, num: int, den: int) -> int:
    """Largest size of a set that can be similar to one of ``size`` elements."""
    return size * den // num


def differences(total: int, num: int, den: int) -> int:
    """Most differing elements of two similar sets with ``total`` elements together."""
    return (den - num) * total // (den + num)


def band(size: int) -> int:
    return size.bit_length() - 1


def signatures(elements: np.ndarray, num: int = 75, den: int = 100) -> np.ndarray:
    """All signatures of one set; sets without possible partners besides equal ones have none."""
    size = len(elements)
    if not size:
        return np.empty(0, np.uint64)
    out = []
    first = band(size)
    last = band(most_partner(size, num, den))
    for i in range(first, last + 1):
        top = (2 << i) - 1
        k = differences(size + min(most_partner(size, num, den), top), num, den)
        if k:
            out.append(_instance(elements, i, differences(2 * top, num, den) // (K2 + 1) + 1, k // (K2 + 1) + 1))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _instance(elements: np.ndarray, i: int, n1: int, wanted: int) -> np.ndarray:
    salt = np.uint64(i + 1) << np.uint64(56)
    hashed = np.sort(mix(elements + salt))  # cells are ranges of the hash, so they come in order
    cell = ((hashed >> np.uint64(32)) * np.uint64(n1 * N2) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    content = np.zeros(n1 * N2, np.uint64)
    content[cell[starts]] = mix(np.add.reduceat(mix(hashed), starts))
    content = content.reshape(n1, N2)
    filled = content != 0
    good = np.cumsum(filled.sum(1) > K2)
    weak = good[-1] < wanted
    until = n1 if weak else int(np.searchsorted(good, wanted)) + 1
    part = mix(np.arange(until, dtype=np.uint64) + salt)
    out = []
    for s, subset in enumerate(SUBSETS):
        some = filled[:until][:, subset].any(1)
        value = part + np.uint64(s + 1)
        for j, member in enumerate(subset):
            value = value + content[:until, member] * np.uint64(2 * j + 0x9E3779B97F4A7C15)
        out.append(mix(value[some]))
    if weak:
        out.append(mix(hashed ^ np.uint64(0xE1E3)))
    return np.concatenate(out)
