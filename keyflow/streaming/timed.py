"""Keyed state with timers: event-time buffering, windows that fire once, late rows as an output.

These processors read the watermark (or the processing time) themselves, so the
event time must reach them as a plain number: Spark drops late rows before an
operator whose input still has its watermark column, and then nobody sees them.
:func:`timed` makes such an input from a stream with a watermark.

``outputStructType`` schemas are given by each processor's ``schema``.  A card's or
window key's rows of one micro-batch are one task's; windows may be salted
(``salt``), since the states of a window's salts merge.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.operators.accumulate import Accumulator, merged_states, results

#: Event time as a number: microseconds since 1970.
TIME = "ts_us"


def timed(stream: DataFrame, ts: str, *keep: str) -> DataFrame:
    """The kept columns and the event time in microseconds, in place of ``ts``."""
    return stream.select(*keep, F.unix_micros(ts).alias(TIME))


def _times(us: np.ndarray) -> np.ndarray:
    return us.astype("datetime64[us]")


class EventTimePairMatcher(StatefulProcessor):
    """Strict next pairs of a key in event-time order, however the rows arrive (the card fraud pattern).

    A list state buffers a key's rows until the watermark has passed them.  A timer
    wakes the key at its oldest buffered row; then all rows up to the watermark
    leave the buffer in (time, id) order, and each is tested against the one
    released before it (value state).  A row at or behind the watermark, whose
    successor may have been tested already, comes out with ``output`` = ``late``
    (its own columns as ``first_*``), as does a row without an event time; pairs have
    ``output`` = ``pair``.

    The pattern: both amounts under ``limit``, less than ``within_us`` apart, at two
    known and different places.
    """

    ROW = "ts long, id long, amount double, location string"

    def __init__(self, key: str = "card", id_col: str = "event_id", amount: str = "amount", location: str = "location",
                 limit: float = 50.0, within_us: int = 300_000_000):
        self.key, self.id, self.amount, self.location = key, id_col, amount, location
        self.limit, self.within_us = limit, within_us

    def schema(self, key_type: T.DataType) -> T.StructType:
        side = [("event_id", T.LongType()), ("ts", T.TimestampType()), ("amount", T.DoubleType()), ("location", T.StringType())]
        return T.StructType([T.StructField("output", T.StringType()), T.StructField(self.key, key_type),
                             *[T.StructField(f"{of}_{name}", kind) for of in ("first", "second") for name, kind in side]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.ROW)
        self.last = handle.getValueState("last", self.ROW)
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        oldest = None
        for pdf in rows:
            if pdf.empty:
                continue
            known = pdf[TIME].notna().to_numpy()
            us = pdf[TIME].fillna(0).to_numpy().astype("int64")
            late = ~known | (us // 1000 <= mark)
            if late.any():
                yield self._rows("late", key, self._columns(pdf[late], us[late], known[late]), None)
            if not late.all():
                ts, ids, amounts, places = self._columns(pdf[~late], us[~late], known[~late])
                self.waiting.appendList([(int(t), int(i), float(a), p if isinstance(p, str) else None)
                                         for t, i, a, p in zip(ts, ids, amounts, places, strict=True)])
                oldest = min(int(ts.min()) // 1000, oldest if oldest is not None else int(ts.min()) // 1000)
        if oldest is not None:
            self._wake(oldest)

    def _columns(self, pdf: pd.DataFrame, us: np.ndarray, known: np.ndarray) -> tuple:
        ts = us if known.all() else np.where(known, us, np.iinfo("int64").min)
        return (ts, pdf[self.id].to_numpy().astype("int64"), pdf[self.amount].to_numpy().astype("float64"),
                pdf[self.location].to_numpy().astype(object))

    def _wake(self, at: int) -> None:
        """Have a timer at ``at`` or earlier: one per key, not one per row."""
        current = self.alarm.get()
        if current is not None:
            if current[0] <= at:
                return
            self.handle.deleteTimer(current[0])
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        self.alarm.clear()
        rows = sorted(self.waiting.get(), key=lambda r: (r[0], r[1])) if self.waiting.exists() else []
        cut = next((i for i, r in enumerate(rows) if r[0] // 1000 > mark), len(rows))
        if cut < len(rows):
            self.waiting.put(rows[cut:])
            self._wake(rows[cut][0] // 1000)
        elif rows:
            self.waiting.clear()
        if cut:
            released = ([self.last.get()] if self.last.exists() else []) + rows[:cut]
            self.last.update(released[-1])
            yield from self._pairs(key, released)

    def _pairs(self, key, rows: Sequence[tuple]) -> Iterator[pd.DataFrame]:
        ts, ids = (np.array([r[i] for r in rows], "int64") for i in (0, 1))
        amounts = np.array([np.nan if r[2] is None else r[2] for r in rows], "float64")
        places = np.array([r[3] for r in rows], object)
        known = np.array([p is not None for p in places])
        a, b = slice(None, -1), slice(1, None)
        hit = (known[a] & known[b] & (places[a] != places[b]) & (amounts[a] < self.limit) & (amounts[b] < self.limit)
               & (ts[b] - ts[a] < self.within_us))
        if hit.any():
            side = lambda s: (ts[s][hit], ids[s][hit], amounts[s][hit], places[s][hit])
            yield self._rows("pair", key, side(a), side(b))

    def _rows(self, output: str, key, first: tuple, second: tuple | None) -> pd.DataFrame:
        n = len(first[0])
        columns = {"output": [output] * n, self.key: [key[0]] * n}
        for name, side in (("first", first), ("second", second)):
            ts, ids, amounts, places = side if side is not None else ([None] * n,) * 4
            if side is not None:
                ts = [None if t == np.iinfo("int64").min else pd.Timestamp(int(t), unit="us") for t in ts]
            columns |= {f"{name}_event_id": ids, f"{name}_ts": pd.Series(ts, dtype="datetime64[us]"),
                        f"{name}_amount": amounts, f"{name}_location": places}
        return pd.DataFrame(columns)

    def close(self) -> None:
        pass


class TimedWindows(StatefulProcessor):
    """Tumbling or sliding windows of a user's accumulator; every window fires once.

    Event time (``processing=False``, ``timeMode="EventTime"``): rows fall into windows
    by their time.  A window fires when the watermark reaches its end; a row all of
    whose windows have ended by then comes out with ``output`` = ``late`` and its
    ``carry`` columns, so what is dropped can be counted or kept (rows without an
    event time too).  Processing time (``timeMode="ProcessingTime"``): rows fall into
    the window of the moment they are processed, and nothing is late.

    State per key: a map from window start to the accumulator's packed state, and a
    timer per open window.  Fired rows have ``output`` = ``window`` and the state, for
    :func:`fired_windows` to merge over salts.
    """

    def __init__(self, accumulator: Accumulator, inputs: Sequence[str], keys: Sequence[tuple[str, str]], size_ms: int,
                 slide_ms: int | None = None, carry: Sequence[tuple[str, str]] = (), processing: bool = False):
        self.accumulator, self.inputs, self.keys, self.carry = accumulator, list(inputs), list(keys), list(carry)
        self.size, self.slide, self.processing = size_ms * 1000, (slide_ms or size_ms) * 1000, processing

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(
            ["output string", *[f"`{n}` {t}" for n, t in (*self.keys, *self.carry)],
             "window_start timestamp", "window_end timestamp", "state binary"]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "state binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = (timerValues.getCurrentProcessingTimeInMs() if self.processing else timerValues.getCurrentWatermarkInMs())
        changed: dict[int, object] = {}
        for pdf in rows:
            if pdf.empty:
                continue
            values = [pdf[c].to_numpy() for c in self.inputs]
            if self.processing:
                us, known = np.full(len(pdf), now * 1000, "int64"), np.ones(len(pdf), bool)
            else:
                us, known = pdf[TIME].fillna(0).to_numpy().astype("int64"), pdf[TIME].notna().to_numpy()
            met = np.zeros(len(pdf), bool)
            for i in range(-(-self.size // self.slide)):
                start = us - us % self.slide - i * self.slide
                open_ = known & (us < start + self.size)
                if not self.processing:
                    open_ &= (start + self.size) // 1000 > now
                met |= open_
                order = np.argsort(start[open_], kind="stable")
                places = np.flatnonzero(open_)[order]
                starts, cuts = np.unique(start[places], return_index=True)
                for s, part in zip(starts.tolist(), np.split(places, cuts[1:]), strict=False):
                    if s not in changed:
                        changed[s] = self._state(s)
                    changed[s] = self.accumulator.add(changed[s], *[v[part] for v in values])
            if not met.all():
                yield self._late(key, pdf[~met])
        for s, state in changed.items():
            self.windows.updateValue((s,), (self.accumulator.pack(state),))

    def _state(self, start: int):
        if self.windows.containsKey((start,)):
            return self.accumulator.unpack(bytes(self.windows.getValue((start,))[0]))
        self.handle.registerTimer((start + self.size) // 1000)
        return self.accumulator.create()

    def _late(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        none = pd.Series([pd.NaT] * n, dtype="datetime64[us]")
        return pd.DataFrame({"output": ["late"] * n, **{c: [key[i]] * n for i, (c, _) in enumerate(self.keys)},
                             **{c: pdf[c].to_numpy() for c, _ in self.carry},
                             "window_start": none, "window_end": none, "state": [None] * n})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        start = end - self.size
        if not self.windows.containsKey((start,)):
            return
        state = bytes(self.windows.getValue((start,))[0])
        self.windows.removeKey((start,))
        yield pd.DataFrame({"output": ["window"], **{c: [key[i]] for i, (c, _) in enumerate(self.keys)},
                            **{c: [None] for c, _ in self.carry},
                            "window_start": pd.Series([pd.Timestamp(start, unit="us")], dtype="datetime64[us]"),
                            "window_end": pd.Series([pd.Timestamp(end, unit="us")], dtype="datetime64[us]"), "state": [state]})

    def close(self) -> None:
        pass


def windowed(stream: DataFrame, keys: Sequence[str], windows: TimedWindows, salt: str | None = None, salts: int = 16) -> DataFrame:
    """Run ``windows`` per key; with ``salt`` (a column) a key's rows are dealt over ``salts`` tasks.

    All salts of a window fire in the same micro-batch, as watermark and processing
    time are the query's, so :func:`fired_windows` can merge them there.
    """
    dealt = F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int") if salt else F.lit(0)
    return stream.withColumn("_salt", dealt).groupBy(*keys, "_salt").transformWithStateInPandas(
        statefulProcessor=windows, outputStructType=windows.schema(), outputMode="Append",
        timeMode="ProcessingTime" if windows.processing else "EventTime")


def fired_windows(fired: DataFrame, windows: TimedWindows, result: str, sink: str, checkpoint: str,
                  processing_time: str | None = None) -> StreamingQuery:
    """Write each micro-batch's windows (salts merged) and late rows below ``sink``, exactly once.

    A batch run again overwrites its own folders.  Without ``processing_time`` the
    query drains what is there and stops.
    """
    keys = [*[n for n, _ in windows.keys], "window_start", "window_end"]
    carry = [n for n, _ in windows.carry]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, raw = batch.sparkSession, f"{sink}/fired/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(raw)  # the stateful operator runs once; both outputs read its rows
        rows = spark.read.schema(batch.schema).parquet(raw)
        states = rows.filter("output = 'window'").select(*keys, F.lit(0).alias("_slot"), "state")
        merged = merged_states(states, keys, windows.accumulator, slots=1)
        results(merged, windows.accumulator, result).write.mode("overwrite").parquet(f"{sink}/windows/batch_id={batch_id}")
        if carry:
            late = rows.filter("output = 'late'").select(*[n for n, _ in windows.keys], *carry)
            late.write.mode("overwrite").parquet(f"{sink}/late/batch_id={batch_id}")

    writer = fired.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def read_fired(spark: SparkSession, sink: str, output: str) -> DataFrame:
    """All rows of one output (``windows`` or ``late``) of :func:`fired_windows`, with their ``batch_id``."""
    return spark.read.option("basePath", f"{sink}/{output}").parquet(f"{sink}/{output}")
