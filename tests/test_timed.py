"""Timers and late rows on streams: event-time matching, windows that fire once, end of input, changed queries."""

import datetime as dt
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.operators import fraud_pairs, window_count
from keyflow.operators.accumulate import Count
from keyflow.session import shared_path
from keyflow.sources import stream_table
from keyflow.streaming.changes import changelog_batches, changes, folded, read_changes
from keyflow.streaming.ending import end_input, until_end
from keyflow.streaming.resume import resumable_stream
from keyflow.streaming.stateful import BucketedRunningCounter, ItemHistory, carried_counts
from keyflow.streaming.timed import TIME, EventTimePairMatcher, TimedWindows, fired_windows, read_fired, timed, windowed

T0 = dt.datetime(2024, 5, 1)
def fields(*named):
    return T.StructType([T.StructField(n, kind()) for n, kind in named])


CARD = fields(("card", T.StringType), ("amount", T.DoubleType), ("location", T.StringType), ("ts", T.TimestampType), ("event_id", T.LongType))


def at(sec):
    return T0 + dt.timedelta(seconds=sec)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_rows_out_of_order_are_matched_in_event_time(spark):
    """One hot card; rows land out of order within the delay: the batch pattern's pairs. What comes later is labelled late."""
    base = shared_path(spark, "tests", "event_time_pairs", fresh=True)
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.6 else f"c{rng.randint(0, 3)}", rng.choice([1.0, 20.0, 80.0, None]),
             rng.choice(["x", "y", None]), at(i * 20), i) for i in range(240)]
    arrival = sorted(rows, key=lambda r: (r[3] - T0).total_seconds() + rng.random() * 100)
    matcher = EventTimePairMatcher()

    def run(some):
        spark.createDataFrame(some, CARD).coalesce(1).write.mode("append").parquet(f"{base}/in")
        go()

    def go():
        stream = until_end(stream_table(spark, f"{base}/in", schema=CARD), "ts", "2 minutes")
        pairs = timed(stream, "ts", "card", "amount", "location", "event_id").groupBy("card").transformWithStateInPandas(
            statefulProcessor=matcher, outputStructType=matcher.schema(T.StringType()), outputMode="Append", timeMode="EventTime")
        finish(resumable_stream(pairs, f"{base}/out", f"{base}/ck"))

    run(arrival[:90])
    run(arrival[90:])
    run([("hot", 1.0, "z", at(10), 1000), ("c1", 1.0, "z", None, 1001)])   # far behind the watermark; without a time
    end_input(spark, f"{base}/in", CARD, "ts")
    go()
    out = spark.read.parquet(f"{base}/out").collect()
    want = fraud_pairs(spark.createDataFrame(rows, CARD), order=["ts", "event_id"], id_col="event_id").collect()
    assert {(r.card, r.first_event_id, r.second_event_id) for r in out if r.output == "pair"} == {
        (r.card, r.first_event_id, r.second_event_id) for r in want}
    assert len(want) > 10
    assert sorted((r.first_event_id, r.first_ts is None) for r in out if r.output == "late") == [(1000, False), (1001, True)]


EVENT = fields(("event_id", T.LongType), ("ts", T.TimestampType), ("event_type", T.StringType))


def test_sliding_windows_fire_once_and_late_rows_come_out(spark):
    base = shared_path(spark, "tests", "timed_windows", fresh=True)
    keys = [("event_type", "string")]
    windows = TimedWindows(Count(), ["event_id"], [*keys, ("_salt", "int")], 10_000, 5_000, carry=[("event_id", "long"), (TIME, "long")])
    merged = TimedWindows(Count(), [], keys, 10_000, 5_000, carry=windows.carry)

    def run(rows):
        if rows:
            spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = until_end(stream_table(spark, f"{base}/in", schema=EVENT), "ts", "2 seconds")
        fired = windowed(timed(stream, "ts", "event_id", "event_type"), ["event_type"], windows, salt="event_id", salts=3)
        finish(fired_windows(fired, merged, "cnt long", f"{base}/out", f"{base}/ck"))

    run([(i, at(i), "a") for i in range(14)])                    # watermark 11 s: the windows ending at 5 and 10 s fire
    run([(100, at(3), "a"), (101, at(8), "a"), (102, at(21), "a")])   # 3 s: late; 8 s: late for its first window only
    end_input(spark, f"{base}/in", EVENT, "ts")
    run([])
    out = read_fired(spark, f"{base}/out", "windows").collect()
    got = sorted(((r.window_start - T0).total_seconds(), r.cnt) for r in out)
    assert got == [(-5.0, 5), (0.0, 10), (5.0, 10), (10.0, 4), (15.0, 1), (20.0, 1)]
    assert [r.event_id for r in read_fired(spark, f"{base}/out", "late").collect()] == [100]


def test_append_mode_has_every_window_after_the_end(spark):
    base = shared_path(spark, "tests", "ending", fresh=True)

    def run():
        stream = until_end(stream_table(spark, f"{base}/in", schema=EVENT), "ts", "2 seconds")
        finish(resumable_stream(window_count(stream, "ts", ["event_type"], "5 seconds"), f"{base}/out", f"{base}/ck"))
        return spark.read.schema("cnt long").parquet(f"{base}/out").agg(F.sum("cnt")).first()[0]

    spark.createDataFrame([(i, at(i), "a") for i in range(13)], EVENT).write.parquet(f"{base}/in")
    assert run() == 10                                           # the last window is still open
    end_input(spark, f"{base}/in", EVENT, "ts")
    assert run() == 13


def test_a_changed_number_of_buckets_goes_on_with_the_counts(spark):
    base = shared_path(spark, "tests", "rebucket", fresh=True)
    words = [f"w{i * i % 17}" for i in range(60)]

    def run(part, rows, buckets):
        spark.createDataFrame(rows, "seq long, word string").write.parquet(f"{base}/in{part}")
        stream = stream_table(spark, f"{base}/in{part}", schema=T.StructType.fromDDL("seq long, word string"))
        carried = carried_counts(spark, f"{base}/ck{part - 1}", "word", buckets).groupBy("_bucket") if part else None
        out = (stream.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(buckets))).groupBy("_bucket").transformWithStateInPandas(
            statefulProcessor=BucketedRunningCounter("word", ["seq"], ["seq", "word"]),
            outputStructType="seq long, word string, cnt long", outputMode="Append", timeMode="None", initialState=carried))
        finish(resumable_stream(out, f"{base}/out{part}", f"{base}/ck{part}"))

    rows = list(enumerate(words))
    run(0, rows[:25], 3)
    run(1, rows[25:], 11)
    got = {r.seq: r.cnt for part in (0, 1) for r in spark.read.parquet(f"{base}/out{part}").collect()}
    assert got == {i: words[:i + 1].count(w) for i, w in rows}


def test_changelog_folds_to_the_totals_after_every_trigger(spark, monkeypatch):
    from keyflow.streaming import changes as module
    monkeypatch.setattr(module, "SNAPSHOT", 2)                   # snapshots and updates are both read
    base = shared_path(spark, "tests", "changes", fresh=True)
    schema = T.StructType.fromDDL("product string, sale double")
    slices = [[("p", 10.0), ("q", 1.5)], [("p", 5.0), (None, 2.0)], [("q", 0.0), (None, None)], [("r", None), ("p", -15.0)], [("r", 4.0)]]
    landed = []
    for some in slices:
        landed += some
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        totals = stream_table(spark, f"{base}/in", schema=schema).groupBy("product").agg(F.sum("sale").alias("total"))
        finish(changelog_batches(totals, ["product"], "total", f"{base}/log", f"{base}/ck"))
        log = read_changes(spark, f"{base}/log")
        want = {r.product: r.total for r in spark.createDataFrame(landed, schema).groupBy("product").agg(F.sum("sale").alias("total")).collect()}
        assert {r.product: r.total for r in folded(log, ["product"], "total").collect()} == want
        signed = log.groupBy("product").agg(F.sum(F.when(F.col("op") == "+", F.col("total")).otherwise(-F.col("total"))).alias("total"))
        assert {r.product: r.total or 0 for r in signed.collect()} == {k: v or 0 for k, v in want.items()}
    assert log.filter("batch_id = 2 and product = 'q'").count() == 0   # an unchanged total says nothing


def test_changes_take_null_keys_and_totals_as_values(spark):
    schema = "k string, total double"
    before = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 2.0)], schema)
    updates = spark.createDataFrame([(None, 3.0), ("a", None), ("b", None), ("c", None)], schema)
    got = sorted(map(tuple, changes(before, updates, ["k"], "total").collect()), key=repr)
    assert got == sorted([(None, "-", 0, 1.0), (None, "+", 1, 3.0), ("b", "-", 0, 2.0), ("b", "+", 1, None), ("c", "+", 1, None)], key=repr)


class _List:
    """A list state in memory."""

    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows


class _Handle:
    def __init__(self):
        self.state = _List()

    def getListState(self, *_):
        return self.state


def history(batches, **options):
    processor, handle = ItemHistory(["seq"], "item", ["seq"], **options), _Handle()
    processor.init(handle)
    out = [f for b in batches for f in processor.handleInputRows(("u",), iter([b]), None)]
    return (pd.concat(out, ignore_index=True) if out else pd.DataFrame()), handle.state


@pytest.mark.parametrize("cap", [None, 1, 3, 10])
@pytest.mark.parametrize("cells", [1, 7, 1 << 20])
def test_item_history_equals_a_plain_list(monkeypatch, cap, cells):
    monkeypatch.setattr(ItemHistory, "CELLS", cells)
    rng = random.Random(7)
    items = [rng.choice("ABCDE") for _ in range(60)]
    cuts = [0, 4, 5, 30, 60]
    batches = [pd.DataFrame({"seq": range(a, b), "item": items[a:b]}) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    got, state = history(batches, cap=cap)
    want, seen = [], []
    for i, x in enumerate(items):
        past = seen if cap is None else seen[-cap:]
        want += [(i, *sorted((x, y)), past.count(y)) for y in sorted(set(past)) if y != x]
        seen.append(x)
    assert sorted(zip(got.seq, got.item_a, got.item_b, got.inc, strict=True)) == sorted(want)
    assert len(state.rows) <= (ItemHistory.COMPACT * 5 + 5 if cap is None else cap)


def test_a_user_with_200_000_views_in_one_batch_stays_within_memory():
    n, items = 200_000, np.array([f"i{k}" for k in range(40)], object)
    batch = pd.DataFrame({"seq": np.arange(n), "item": items[np.arange(n) * 7 % 40]})
    processor, handle = ItemHistory(["seq"], "item", ["seq"]), _Handle()
    processor.init(handle)
    tracemalloc.start()
    rows = sum(len(f) for f in processor.handleInputRows(("u",), iter([batch]), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == sum(min(i, 40) - (1 if i >= 40 else 0) for i in range(n))
    assert peak < 200 * 2**20          # the full matrix of counts alone would have 64 MB a copy, several of them
