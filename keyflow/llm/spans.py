"""Span helpers shared by the scanners of secrets and of personal data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


def joined(spans: Iterable[tuple[str, int, int]], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then kind as listed, then end; comma-joined."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2])))


def counts(rows: list[list[tuple]], kind: str) -> np.ndarray:
    return np.array([sum(s[0] == kind for s in spans) for spans in rows], np.int64)
