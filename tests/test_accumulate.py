"""User-defined accumulators: partial states per task, a tree of merges, nulls and a hot key."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from keyflow.operators.accumulate import Accumulator, Count, Mode, accumulate, merged_states, partial_states


def user_range():
    """A user's own accumulator, smallest to largest value (in a function, so that it travels with the task)."""
    class Range(Accumulator):
        def create(self):
            return None

        def add(self, state, *columns):
            low, high = float(np.min(columns[0])), float(np.max(columns[0]))
            return (low, high) if state is None else (min(low, state[0]), max(high, state[1]))

        def merge(self, a, b):
            return (min(a[0], b[0]), max(a[1], b[1]))

        def result(self, state):
            return (state[1] - state[0],)

    return Range()


def test_mode_with_ties_nulls_and_a_hot_key_over_many_tasks(spark):
    rows = [("hot" if i % 3 else (None if i % 2 else "cold"), None if i % 11 == 0 else i * 7 % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(40)
    got = {r.k: (r.m, r.ties, r.n) for r in accumulate(df, ["k"], Mode(), ["v"], "m long, ties long, n long").collect()}
    want = {}
    for key in ("hot", "cold", None):
        counts = Counter(v for k, v in rows if k == key and v is not None)
        most = max(counts.values())
        ties = [v for v, n in counts.items() if n == most]
        want[key] = (min(ties), len(ties), most)
    assert got == want


def test_a_key_is_merged_round_by_round(spark):
    df = spark.range(0, 5000, numPartitions=64).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    parts = partial_states(df, ["k"], user_range(), ["v"], slots=64)
    assert parts.count() == 128                       # a state per task and key
    assert merged_states(parts, ["k"], user_range(), slots=64, fan_in=4).count() == 2
    got = {r.k: r.span for r in accumulate(df, ["k"], user_range(), ["v"], "span double").collect()}
    assert got == {0: 4998.0, 1: 4998.0}


def test_count_without_rows_and_without_values(spark):
    empty = spark.createDataFrame([], "k string, v long")
    assert accumulate(empty, ["k"], Count(), ["v"], "n long").count() == 0
    nulls = spark.createDataFrame([("a", None), ("a", None)], "k string, v long")
    assert [tuple(r) for r in accumulate(nulls, ["k"], Mode(), ["v"], "m long, ties long, n long").collect()] == [("a", None, 0, 0)]
    assert [tuple(r) for r in accumulate(nulls, ["k"], Count(), ["v"], "n long").collect()] == [("a", 2)]
