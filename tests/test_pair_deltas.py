"""Totals of item pairs on streams with very many users: what leaves a keyed state stays small."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from keyflow.streaming.stateful import BucketedPairDeltas


class _Value:
    def __init__(self):
        self.row = None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def getValueState(self, *_):
        return self


@pytest.mark.parametrize("cells", [1, 30, 1 << 20])
@pytest.mark.parametrize("n_items", [4, 40])
def test_a_bucket_gives_its_users_pairs_summed(monkeypatch, cells, n_items):
    monkeypatch.setattr(BucketedPairDeltas, "CELLS", cells)
    monkeypatch.setattr(BucketedPairDeltas, "HELD", 50)
    rng = random.Random(cells + n_items)
    views = [(rng.choice([None, *(f"u{k}" for k in range(30))]), rng.choice([None, *(f"i{k}" for k in range(n_items))])) for _ in range(600)]
    processor, total, most = BucketedPairDeltas("user", "item"), Counter(), 0
    processor.init(_Value())
    for a, b in ((0, 200), (200, 210), (210, 600)):
        frames = [pd.DataFrame(views[i:min(i + 70, b)], columns=["user", "item"]) for i in range(a, b, 70)]
        out = list(processor.handleInputRows((0,), iter(frames), None))
        most = max(most, sum(map(len, out)))
        for f in out:
            assert (f["item_a"] < f["item_b"]).all() and (f["inc"] > 0).all()
            for x, y, inc in f.itertuples(index=False):
                total[x, y] += int(inc)
    counts, want = Counter(v for v in views if v[1] is not None), Counter()
    for (u, x), n in counts.items():
        for (v, y), m in counts.items():
            if u == v and x < y:
                want[x, y] += n * m
    assert total == want
    if cells == 1 << 20:                                   # all users in one block: a row per pair, not per user and pair
        assert most <= n_items * (n_items - 1) // 2
    assert np.frombuffer(processor.counts.row[2], np.int64).reshape(-1, 3)[:, 2].sum() == sum(counts.values())
