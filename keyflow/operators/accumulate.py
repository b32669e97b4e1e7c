"""User-defined mergeable aggregates (O-43): create / add / merge / result.

The reference aggregates with a user's accumulator object.  Here an
:class:`Accumulator` runs as a Spark job in three steps:

1. every task folds its rows into one state per key (whole Arrow columns at a
   time) and emits the packed states: this is the map-side combine, so a key with a
   third of all rows costs one state per task, not one group;
2. states are merged in a tree: round by round, the states of ``fan_in`` slots
   (slots number the tasks) meet per key, so no task merges more than its share of
   a hot key's partial states;
3. the last state of each key gives its result row.

States are bounded by the accumulator (a mode keeps the counts of the distinct
values).  Keys may be null.  The same accumulators run on streams, inside
:class:`keyflow.streaming.timed.TimedWindows`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Slots that number the partial states, and states merged at once in a round.
SLOTS, FAN_IN = 256, 16
#: Keys that a task holds before it emits their partial states.
HELD_KEYS = 100_000


class Accumulator:
    """A mergeable aggregate over whole columns; subclasses give all but ``pack`` and ``unpack``."""

    def create(self):
        """The empty state."""
        raise NotImplementedError

    def add(self, state, *columns: np.ndarray):
        """The state with some more rows (a column per input, nulls as None or nan)."""
        raise NotImplementedError

    def merge(self, a, b):
        """The state of both states' rows."""
        raise NotImplementedError

    def result(self, state) -> tuple:
        """The result columns of a final state."""
        raise NotImplementedError

    def pack(self, state) -> bytes:
        return pickle.dumps(state, protocol=pickle.HIGHEST_PROTOCOL)

    def unpack(self, data: bytes):
        return pickle.loads(data)


class Count(Accumulator):
    """Number of rows, the reference's own accumulator."""

    def create(self):
        return 0

    def add(self, state, *columns):
        return state + len(columns[0])

    def merge(self, a, b):
        return a + b

    def result(self, state):
        return (state,)


class Mode(Accumulator):
    """The most frequent value: (smallest of the most frequent, how many share that count, the count).

    Nulls are skipped; without a value the result is (null, 0, 0).
    """

    def create(self):
        return {}

    def add(self, state, *columns):
        values = columns[0]
        values = values[[v is not None and v == v for v in values]] if values.dtype.kind in "Of" else values
        for value, n in zip(*(x.tolist() for x in np.unique(values, return_counts=True)), strict=True):
            state[value] = state.get(value, 0) + n
        return state

    def merge(self, a, b):
        if len(a) < len(b):
            a, b = b, a
        for value, n in b.items():
            a[value] = a.get(value, 0) + n
        return a

    def result(self, state):
        most = max(state.values(), default=0)
        ties = [v for v, n in state.items() if n == most]
        return (min(ties, default=None), len(ties), most)


def _column(values: pa.Array) -> np.ndarray:
    """The values as numpy; a column with nulls has objects, so that its numbers stay what they are."""
    return np.array(values.to_pylist() + [None], object)[:-1] if values.null_count else values.to_numpy(zero_copy_only=False)


def partial_states(df: DataFrame, keys: Sequence[str], accumulator: Accumulator, inputs: Sequence[str],
                   slots: int = SLOTS) -> DataFrame:
    """(keys, _slot, state): each task's state of each key."""
    keys, inputs = list(keys), list(inputs)
    kinds = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, states = TaskContext.get().partitionId() % slots, {}

        def held() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in states], kinds[c]) for i, c in enumerate(keys)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([slot] * len(states), pa.int32()),
                 pa.array([accumulator.pack(s) for s in states.values()], pa.binary())], [*keys, "_slot", "state"])

        for batch in batches:
            kinds.update({c: batch.schema.field(c).type for c in keys})
            table = pa.Table.from_batches([batch]).append_column("_row", pa.array(np.arange(len(batch))))
            values = [table.column(c).combine_chunks() for c in inputs]
            grouped = table.group_by(keys, use_threads=False).aggregate([("_row", "list")])
            names = list(zip(*(grouped.column(c).to_pylist() for c in keys), strict=True)) if keys else [()]
            for key, rows in zip(names, grouped.column("_row_list"), strict=True):
                rows = rows.values
                state = states[key] if key in states else accumulator.create()
                states[key] = accumulator.add(state, *[_column(v.take(rows)) for v in values])
            if len(states) >= HELD_KEYS:
                yield held()
                states = {}
        if states:
            yield held()

    schema = T.StructType([df.schema[c] for c in keys] + [T.StructField("_slot", T.IntegerType()), T.StructField("state", T.BinaryType())])
    return df.select(*dict.fromkeys([*keys, *inputs])).mapInArrow(run, schema)


def merged_states(parts: DataFrame, keys: Sequence[str], accumulator: Accumulator, slots: int = SLOTS,
                  fan_in: int = FAN_IN) -> DataFrame:
    """(keys, state) from (keys, _slot, state), merged in rounds of ``fan_in`` slots."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, out, schema = None, None, [], None

        def done() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:  # sorted by key and slot
            schema = batch.schema
            names = zip(*(batch.column(c).to_pylist() for c in [*keys, "_slot"]), strict=True)
            for key, packed in zip(names, batch.column("state"), strict=True):
                if key == last:
                    state = accumulator.merge(state, accumulator.unpack(packed.as_py()))
                    continue
                if last is not None:
                    out.append((*last, accumulator.pack(state)))
                    if len(out) >= 5000:
                        yield done()
                        out = []
                last, state = key, accumulator.unpack(packed.as_py())
        if last is not None:
            out.append((*last, accumulator.pack(state)))
            yield done()

    schema = parts.select(*keys, "_slot", "state").schema
    while True:
        slots = -(-slots // fan_in)
        dealt = parts.select(*keys, F.floor(F.col("_slot") / fan_in).cast("int").alias("_slot"), "state")
        parts = (dealt.repartition(*keys, "_slot").sortWithinPartitions(*keys, "_slot").mapInArrow(run, schema))
        if slots <= 1:
            return parts.drop("_slot")


def results(states: DataFrame, accumulator: Accumulator, schema: str) -> DataFrame:
    """The result columns (``schema``) in place of ``state``."""
    kept = [f for f in states.schema.fields if f.name != "state"]
    added = T.StructType.fromDDL(schema).fields
    names = [f.name for f in (*kept, *added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [accumulator.result(accumulator.unpack(s.as_py())) for s in batch.column("state")]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(added)
            columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, added, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns], names)

    return states.mapInArrow(run, T.StructType([*kept, *added]))


def accumulate(df: DataFrame, keys: Sequence[str], accumulator: Accumulator, inputs: Sequence[str], schema: str) -> DataFrame:
    """One row per key: the keys and the accumulator's result (``schema`` as DDL)."""
    parts = partial_states(df, keys, accumulator, inputs)
    return results(merged_states(parts, keys, accumulator), accumulator, schema)
