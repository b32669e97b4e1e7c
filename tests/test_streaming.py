"""Streaming forms: watermark and late rows (C8), keyed state processors, resume (O-63/O-64)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.operators import event_time, window_count
from keyflow.session import shared_path
from keyflow.sources import stream_table
from keyflow.streaming.resume import latest_rows, resumable_stream, upsert_batches
from keyflow.streaming.stateful import AdjacentPairMatcher, ItemHistory, RunningCounter

T0 = dt.datetime(2024, 5, 1, 0, 0, 0)
SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("user_id", T.StringType()), T.StructField("event_type", T.StringType())])


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_late_row_is_dropped_fixture_c8(spark):
    base = shared_path(spark, "tests", "late", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"

    def run():
        stream = event_time(stream_table(spark, landing, schema=SCHEMA), "ts", "2 seconds")
        q = upsert_batches(window_count(stream, "ts", ["event_type"], "5 seconds"), sink, ckpt)
        q.awaitTermination()

    land(spark, landing, [(1, at(1), "u", "a"), (2, at(3), "u", "a"), (3, at(12), "u", "a")])
    run()   # watermark is now 12 - 2 = 10 s: window [0, 5) is closed
    land(spark, landing, [(4, at(2), "u", "a"), (5, at(13), "u", "a")])
    run()
    got = {(r.window_start.replace(tzinfo=None) if r.window_start.tzinfo else r.window_start, r.cnt)
           for r in latest_rows(spark, sink, ["window_start", "event_type"]).collect()}
    got = {((w - T0).total_seconds() if w.tzinfo is None else w, c) for w, c in got}
    assert got == {(0.0, 2), (10.0, 2)}   # the late row at 2 s did not reach [0, 5)


def _run_counter(spark, landing, sink, ckpt):
    stream = stream_table(spark, landing, schema=SCHEMA)
    out = stream.groupBy("user_id").transformWithState(
        statefulProcessor=RunningCounter(["ts", "event_id"], ["event_id", "user_id"]),
        outputStructType="event_id long, user_id string, cnt long", outputMode="Append", timeMode="None")
    q = resumable_stream(out, sink, ckpt)
    q.awaitTermination()


def test_running_counter_resumes_from_checkpoint(spark):
    base = shared_path(spark, "tests", "counter", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    land(spark, landing, [(1, at(1), "user1", "click"), (2, at(2), "user2", "view"),
                          (3, at(3), "user1", "purchase")])
    _run_counter(spark, landing, sink, ckpt)
    land(spark, landing, [(4, at(4), "user3", "click"), (5, at(5), "user2", "click"),
                          (6, at(6), "user1", "view")])
    _run_counter(spark, landing, sink, ckpt)    # restart: state restored, old files skipped
    _run_counter(spark, landing, sink, ckpt)    # nothing new: no duplicates
    got = sorted((r.event_id, r.user_id, r.cnt) for r in spark.read.parquet(sink).collect())
    assert got == [(1, "user1", 1), (2, "user2", 1), (3, "user1", 2), (4, "user3", 1),
                   (5, "user2", 2), (6, "user1", 3)]


def test_pair_matcher_across_batches(spark):
    base = shared_path(spark, "tests", "pairs", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "card string, amount double, location string, ts timestamp_ntz, event_id long"
    out_schema = ("card string, first_event_id long, first_ts timestamp, first_amount double, "
                  "first_location string, second_event_id long, second_ts timestamp, "
                  "second_amount double, second_location string")

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL(schema))
        out = stream.groupBy("card").transformWithStateInPandas(
            statefulProcessor=AdjacentPairMatcher(), outputStructType=out_schema,
            outputMode="Append", timeMode="None")
        resumable_stream(out, sink, ckpt).awaitTermination()

    rows1 = [("card1", 10.0, "New York", at(0), 1), ("card2", 20.0, "Paris", at(0), 2),
             ("card3", 5.0, None, at(0), 6)]
    rows2 = [("card1", 15.0, "London", at(60), 3), ("card1", 5.0, "Tokyo", at(120), 4),
             ("card2", 100.0, "Paris", at(180), 5), ("card3", 5.0, "Rome", at(60), 7),
             ("card3", 5.0, None, at(90), 8), ("card3", 5.0, "Oslo", at(120), 9)]
    spark.createDataFrame(rows1, schema).coalesce(1).write.mode("append").parquet(landing)
    run()
    spark.createDataFrame(rows2, schema).coalesce(1).write.mode("append").parquet(landing)
    run()
    got = sorted((r.card, r.first_event_id, r.second_event_id) for r in spark.read.parquet(sink).collect())
    assert got == [("card1", 1, 3), ("card1", 3, 4)]


def test_item_history_emits_factored_pairs(spark):
    base = shared_path(spark, "tests", "history", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    views = [("user1", "itemA"), ("user2", "itemB"), ("user1", "itemC"), ("user3", "itemA"),
             ("user2", "itemC"), ("user1", "itemB"), ("user3", "itemD")]
    land(spark, landing, [(i, at(i), u, it) for i, (u, it) in enumerate(views)])
    stream = stream_table(spark, landing, schema=SCHEMA)
    out = stream.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=ItemHistory(["ts", "event_id"], "event_type", ["event_id"]),
        outputStructType="event_id long, event_type string, item_a string, item_b string, inc long",
        outputMode="Append", timeMode="None")
    resumable_stream(out, sink, ckpt).awaitTermination()
    got = sorted((r.event_id, r.item_a, r.item_b, r.inc) for r in spark.read.parquet(sink).collect())
    assert got == [(2, "itemA", "itemC", 1), (4, "itemB", "itemC", 1), (5, "itemA", "itemB", 1),
                   (5, "itemB", "itemC", 1), (6, "itemA", "itemD", 1)]


def test_retract_changelog_processor_across_batches(spark):
    from keyflow.streaming.stateful import RetractChangelog
    base = shared_path(spark, "tests", "changelog", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "product string, n long, sale double"

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL(schema))
        out = stream.groupBy("product").transformWithState(
            statefulProcessor=RetractChangelog(["n"], "sale", ["product", "n"], scale=5),
            outputStructType="product string, n long, op string, seq int, total double",
            outputMode="Append", timeMode="None")
        resumable_stream(out, sink, ckpt).awaitTermination()

    spark.createDataFrame([("p", 1, 10.0)], schema).write.mode("append").parquet(landing)
    run()
    spark.createDataFrame([("p", 2, 5.0), ("p", 3, 0.0)], schema).write.mode("append").parquet(landing)
    run()
    got = sorted((r.n, r.seq, r.op, r.total) for r in spark.read.parquet(sink).collect())
    assert got == [(1, 1, "+", 10.0), (2, 0, "-", 10.0), (2, 1, "+", 15.0)]


def test_state_can_be_inspected_after_stop(spark):
    from keyflow.streaming.resume import read_state
    base = shared_path(spark, "tests", "inspect", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    land(spark, landing, [(1, at(1), "user1", "click"), (2, at(2), "user1", "view"),
                          (3, at(3), "user2", "view")])
    _run_counter(spark, landing, sink, ckpt)
    state = {r.key.user_id: r.value.c for r in read_state(spark, ckpt, "count").collect()}
    assert state == {"user1": 2, "user2": 1}


def test_page_analysis_reads_each_line_once_for_two_outputs(spark):
    from keyflow.streaming.fanout import read_output, start_page_analysis
    base = shared_path(spark, "tests", "fanout", fresh=True)
    landing = f"{base}/in"
    rows = [("1|u|/hot", at(1))] * 101 + [("1|u|/warm", at(2))] * 100 + [("x", at(3))]
    spark.createDataFrame(rows, "line string, arrival timestamp_ntz").write.parquet(landing)
    lines = stream_table(spark, landing, schema=T.StructType.fromDDL("line string, arrival timestamp_ntz"),
                         event_time_cols=("arrival",))
    query = start_page_analysis(lines, base, "arrival")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)   # both outputs from one read
    alerts = read_output(spark, base, "alerts").collect()
    assert [(r.page, r.cnt) for r in alerts] == [("/hot", 101)] and alerts[0].alert
    views = {((r.window_start.replace(tzinfo=None) - T0).total_seconds(), r.page, r.cnt) for r in read_output(spark, base, "views").collect()}
    assert views == {(s, p, c) for s in (-5.0, 0.0) for p, c in (("/hot", 101), ("/warm", 100))}


def test_running_mean_fixture_a10_as_stream(spark):
    from keyflow.streaming.stateful import RunningMean
    base = shared_path(spark, "tests", "mean", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "seq long, sensor string, reading double"
    rows = [(1, "s1", 10.5), (2, "s1", 11.2), (3, "s2", 22.1), (4, "s1", 12.8), (5, "s2", 23.4)]

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL(schema))
        out = stream.groupBy("sensor").transformWithState(
            statefulProcessor=RunningMean(["seq"], ["seq", "sensor"], "reading", scale=1),
            outputStructType="seq long, sensor string, avg_value double",
            outputMode="Append", timeMode="None")
        resumable_stream(out, sink, ckpt).awaitTermination()

    spark.createDataFrame(rows[:2], schema).write.mode("append").parquet(landing)
    run()
    spark.createDataFrame(rows[2:], schema).write.mode("append").parquet(landing)
    run()
    got = [r.avg_value for r in spark.read.parquet(sink).orderBy("seq").collect()]
    assert got == pytest.approx([10.5, 10.85, 22.1, 11.5, 22.75], abs=1e-9)


def test_pair_deltas_sum_to_cooccurrence_totals(spark):
    from collections import Counter

    from keyflow.streaming.resume import additive_batches, sum_batches
    from keyflow.streaming.stateful import PairDeltas
    base = shared_path(spark, "tests", "pair_deltas", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    views = [("u1", "A"), ("u2", "B"), ("u1", "C"), ("u3", "A"), ("u2", "C"), ("u1", "B"),
             ("u3", "D"), ("u1", "A"), ("u1", "A"), ("u2", "B")]

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL("u string, item string"))
        deltas = stream.groupBy("u").transformWithState(
            statefulProcessor=PairDeltas("item"),
            outputStructType="item_a array<string>, item_b array<string>, inc array<long>",
            outputMode="Append", timeMode="None")
        cells = deltas.select(F.explode(F.arrays_zip("item_a", "item_b", "inc")).alias("d")).select(
            "d.item_a", "d.item_b", F.col("d.inc").alias("cnt"))
        additive_batches(cells, ["item_a", "item_b"], "cnt", sink, ckpt).awaitTermination()

    for chunk in (views[:4], views[4:7], views[7:]):
        spark.createDataFrame(chunk, "u string, item string").coalesce(1).write.mode("append").parquet(landing)
        run()
    hist, want = {}, Counter()
    for u, it in views:                       # the per-event pairing
        for prev in hist.get(u, []):
            if prev != it:
                want[tuple(sorted((prev, it)))] += 1
        hist.setdefault(u, []).append(it)
    got = {(r.item_a, r.item_b): r.cnt for r in sum_batches(spark, sink, ["item_a", "item_b"], "cnt").collect()}
    assert got == dict(want)


def test_bucketed_running_counter_across_batches(spark):
    from keyflow.streaming.stateful import BucketedRunningCounter
    base = shared_path(spark, "tests", "bucketed", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "seq long, word string"
    words = ["a", "b", "a", "c", "a", "b", "d", "a", "c", "e"]

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL(schema))
        out = (stream.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(3)))
               .groupBy("_bucket").transformWithStateInPandas(
                   statefulProcessor=BucketedRunningCounter("word", ["seq"], ["seq", "word"]),
                   outputStructType="seq long, word string, cnt long", outputMode="Append", timeMode="None"))
        resumable_stream(out, sink, ckpt).awaitTermination()

    for offset, part in ((0, words[:4]), (4, words[4:])):
        spark.createDataFrame([(offset + i, w) for i, w in enumerate(part)], schema) \
            .coalesce(1).write.mode("append").parquet(landing)
        run()
    seen, want = {}, []
    for i, w in enumerate(words):
        seen[w] = seen.get(w, 0) + 1
        want.append((i, w, seen[w]))
    got = sorted((r.seq, r.word, r.cnt) for r in spark.read.parquet(sink).collect())
    assert got == want


def test_changelog_across_batches(spark):
    from keyflow.operators import retract_changelog
    from keyflow.streaming.stateful import RetractChangelog
    base = shared_path(spark, "tests", "changelog", fresh=True)
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "product long, n long, sale double"
    rows = [(1, 1, 10.0), (2, 2, 5.5), (1, 3, 5.0), (3, 4, 1.25), (2, 5, 0.0),
            (1, 6, 0.0), (3, 7, 2.125), (4, 8, None), (2, 9, 0.0045), (1, 10, None), (4, 11, 0.00005),
            (5, 12, None), (1, 13, 3.0), (None, 14, 2.5)]

    def run():
        stream = stream_table(spark, landing, schema=T.StructType.fromDDL(schema))
        out = stream.groupBy("product").transformWithState(
            statefulProcessor=RetractChangelog(["n"], "sale", ["product", "n"], scale=5),
            outputStructType="product long, n long, op string, seq int, total double",
            outputMode="Append", timeMode="None")
        resumable_stream(out, sink, ckpt).awaitTermination()

    for part in (rows[:4], rows[4:7], rows[7:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        run()
    want = retract_changelog(spark.createDataFrame(rows, schema), "product", ["n"], "sale", scale=5)
    key = lambda r: (r.product or 0, r.n, r.seq, r.op, r.total)
    assert sorted(map(key, spark.read.parquet(sink).collect())) == sorted(map(key, want.collect()))
