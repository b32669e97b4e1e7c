"""Registered stream queries: the reference's programs as Structured Streaming jobs.

Most are twins of a batch query: a table is landed in time-ordered slices, the stream
runs after every slice from one checkpoint (stop and restart each time), and the
result read back from the sink must equal the batch query's, so both share one
oracle.  The others show what only a stream has: rows out of order, late rows,
timers, the end of input, changed queries, changelogs per trigger.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.formats import counter_text, fraud_text
from keyflow.functions.numeric import doubled, guarded_double, is_even, parity
from keyflow.functions.parse import accepted, parse_behavior
from keyflow.functions.text import tokenize, upper_text
from keyflow.operators.sql import declare_sales_view, sales_per_product
from keyflow.operators.windows import event_time, window_count, window_sum
from keyflow.session import shared_path
from keyflow.sources.streams import stream_table
from keyflow.sources.tables import behavior_lines, load, page_log_lines
from keyflow.functions.formats import event_label
from keyflow.operators.accumulate import Count, Mode
from keyflow.plans.landing import finish, land_slices, run_in_slices, slice_bounds, slice_filter, slice_number
from keyflow.plans.queries import MODE_RESULT, MONEY, TRAFFIC_THRESHOLD, TRAFFIC_WINDOW
from keyflow.streaming.changes import changelog_batches, folded, read_changes
from keyflow.streaming.ending import end_input, until_end
from keyflow.streaming.fanout import read_output, start_page_analysis
from keyflow.streaming.resume import (additive_batches, latest_rows, pinned, resumable_stream, sum_batches,
                                      upsert_batches)
from keyflow.streaming.running import carried_totals, read_running, running_batches
from keyflow.streaming.stateful import (AdjacentPairMatcher, BucketedPairDeltas, BucketedRunningCounter, ItemHistory,
                                        RetractChangelog, RunningMean, carried_counts)
from keyflow.streaming.timed import TIME, EventTimePairMatcher, TimedWindows, fired_windows, read_fired, timed, windowed

N_SLICES = 3
# Hash buckets per shuffle partition for keyed state with very many small keys (words, customers), at a stream's first start.
WORD_BUCKETS_PER_PARTITION = 16


def _paths(spark: SparkSession, name: str) -> tuple[str, str, str]:
    base = shared_path(spark, "twins", name, fresh=True)
    return f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def q_stream_event_time_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed 5 s event-time counts with a 2 s watermark, update mode, folded per window."""
    landing, sink, ckpt = _paths(spark, "event_time_counts")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")

    def start():
        stream = event_time(stream_table(spark, landing, schema=events.schema), "ts", "2 seconds")
        counts = window_count(stream, "ts", ["event_type"], "5 seconds")
        return upsert_batches(counts, sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    out = latest_rows(spark, sink, ["window_start", "event_type"])
    return _ntz(out, "window_start", "window_end")


def _counter_stream(spark: SparkSession, sf_dir: str, name: str, key: str, cols: list[str],
                    key_expr=None) -> DataFrame:
    landing, sink, ckpt = _paths(spark, name)
    events = load(spark, sf_dir, "events").select(*cols)

    def start():
        stream = stream_table(spark, landing, schema=events.schema)
        if key_expr is not None:
            stream = stream.withColumn(key, key_expr)
        finish(running_batches(stream, [key], ["ts", "event_id"], sink, ckpt))
        return carried_totals(spark, [stream.schema[key]], sink, f"{ckpt}-carried")

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    return read_running(spark, [key], sink).drop("ts")


def q_stream_running_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user running count from keyed value state, one row per event."""
    return _counter_stream(spark, sf_dir, "running_event_count", "user_id",
                           ["event_id", "ts", "user_id", "event_type"])


def q_stream_parity_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter per parity key with its message, from keyed value state."""
    out = _counter_stream(spark, sf_dir, "parity_counter", "parity", ["event_id", "ts"],
                          key_expr=parity("event_id"))
    return out.withColumn("message", counter_text("parity", "event_id", "cnt"))


FRAUD_SCHEMA = T.StructType([
    T.StructField("card", T.LongType()),
    T.StructField("first_event_id", T.LongType()), T.StructField("first_ts", T.TimestampType()),
    T.StructField("first_amount", T.DoubleType()), T.StructField("first_location", T.StringType()),
    T.StructField("second_event_id", T.LongType()), T.StructField("second_ts", T.TimestampType()),
    T.StructField("second_amount", T.DoubleType()), T.StructField("second_location", T.StringType()),
])


def q_stream_fraud_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent small transactions per card from a last-event value state (rows in order of time)."""
    landing, sink, ckpt = _paths(spark, "fraud_pairs")
    events = _cards(spark, sf_dir)

    def start():
        stream = stream_table(spark, landing, schema=events.schema)
        pairs = stream.groupBy("card").transformWithStateInPandas(
            statefulProcessor=AdjacentPairMatcher(), outputStructType=FRAUD_SCHEMA,
            outputMode="Append", timeMode="None")
        return resumable_stream(pairs, sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    return _ntz(_with_alert(spark.read.schema(FRAUD_SCHEMA).parquet(sink)), "first_ts", "second_ts")


def q_stream_sales_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record retract changelog of sales per product from keyed value state."""
    landing, sink, ckpt = _paths(spark, "sales_changelog")
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("product_id"), "o_orderkey", "o_totalprice")

    def start():
        stream = stream_table(spark, landing, schema=orders.schema)
        changes = stream.groupBy("product_id").transformWithState(
            statefulProcessor=RetractChangelog(["o_orderkey"], "o_totalprice",
                                               ["product_id", "o_orderkey"], scale=MONEY),
            outputStructType="product_id long, o_orderkey long, op string, seq int, total double",
            outputMode="Append", timeMode="None")
        return resumable_stream(changes, sink, ckpt)

    run_in_slices(spark, orders, "o_orderkey", N_SLICES, landing, start)
    return spark.read.parquet(sink)


def q_stream_windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of arriving lines counted per 5 s window (lines = event types, arrival = ts)."""
    landing, sink, ckpt = _paths(spark, "windowed_word_count")
    events = load(spark, sf_dir, "events").select("ts", "event_type")

    def start():
        stream = event_time(stream_table(spark, landing, schema=events.schema), "ts", "0 seconds")
        words = tokenize(stream, "event_type", keep=("ts",))
        return upsert_batches(window_count(words, "ts", ["word"], "5 seconds"), sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    out = latest_rows(spark, sink, ["window_start", "word"])
    return _ntz(out, "window_start", "window_end")


def q_stream_rolling_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record running total of each word from keyed value state (conversations by conv_id)."""
    landing, sink, ckpt = _paths(spark, "rolling_word_count")
    # very many small keys: state grouped by a hash bucket of the word; the number of buckets is part of the state's key
    buckets = pinned(spark, f"{ckpt}-buckets",
                     int(spark.conf.get("spark.sql.shuffle.partitions")) * WORD_BUCKETS_PER_PARTITION)
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")

    def start():
        stream = stream_table(spark, landing, schema=conv.schema)
        words = tokenize(stream, "text", keep=("conv_id", "turn"), with_position=True)
        counted = (words.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
                   .groupBy("_bucket").transformWithStateInPandas(
                       statefulProcessor=BucketedRunningCounter(
                           "word", ["conv_id", "turn", "pos"], ["conv_id", "turn", "pos", "word"]),
                       outputStructType="conv_id long, turn long, pos int, word string, cnt long",
                       outputMode="Append", timeMode="None"))
        return resumable_stream(counted, sink, ckpt)

    run_in_slices(spark, conv, "conv_id", N_SLICES, landing, start)
    return spark.read.parquet(sink)


def q_stream_behavior_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV behaviour records parsed on the stream, 5 s watermark, 1 min windows per type."""
    landing, sink, ckpt = _paths(spark, "behavior_counts")
    events = load(spark, sf_dir, "events")

    def start():
        stream = stream_table(spark, landing, schema=events.schema)
        ok = accepted(parse_behavior(behavior_lines(stream), "line", keep=("event_id",)))
        timed = event_time(ok, "event_ts", "5 seconds", millis_col="ts_ms")
        return upsert_batches(window_count(timed, "event_ts", ["behavior_type"], "1 minute"),
                              sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    out = latest_rows(spark, sink, ["window_start", "behavior_type"])
    return _ntz(out, "window_start", "window_end")


def q_stream_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales SQL over a streaming view: a continuously updated SUM per product."""
    landing, sink, ckpt = _paths(spark, "product_sales")
    lineitem = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")

    def start():
        stream = stream_table(spark, landing, schema=lineitem.schema)
        view = declare_sales_view(spark, stream, "kf_stream_sales")
        return upsert_batches(sales_per_product(spark, view, scale=MONEY), sink, ckpt)

    run_in_slices(spark, lineitem, "l_orderkey", N_SLICES, landing, start)
    return latest_rows(spark, sink, ["product_id"])


def _page_analysis(spark: SparkSession, sf_dir: str, output: str) -> DataFrame:
    """Run the page analysis (one stream, two outputs) over sliced events; read one output."""
    base = shared_path(spark, "twins", "page_analysis", fresh=True)
    landing = f"{base}/landing"
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")

    def start():
        lines = page_log_lines(stream_table(spark, landing, schema=events.schema))
        return start_page_analysis(lines, base, "arrival", alert_size=TRAFFIC_WINDOW, threshold=TRAFFIC_THRESHOLD)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    return _ntz(read_output(spark, base, output), "window_start", "window_end")


def q_stream_sliding_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding page views: one of the two outputs of the page analysis stream."""
    return _page_analysis(spark, sf_dir, "views")


def q_stream_traffic_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold alerts: the other output of the page analysis stream."""
    return _page_analysis(spark, sf_dir, "alerts")


def _append_twin(spark: SparkSession, name: str, table: DataFrame, slice_col: str, transform) -> DataFrame:
    """Land ``table`` in slices; stream ``transform(stream)`` into an append-mode file sink."""
    landing, sink, ckpt = _paths(spark, name)

    def start():
        return resumable_stream(transform(stream_table(spark, landing, schema=table.schema)), sink, ckpt)

    run_in_slices(spark, table, slice_col, N_SLICES, landing, start)
    return spark.read.parquet(sink)


def q_stream_upper_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper-case map over a stream of parts."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _append_twin(spark, "upper_map", part, "p_partkey", lambda st: st.select(
        "p_partkey", "p_name", upper_text("p_name").alias("upper_name")))


def q_stream_double_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double, then keep even, over a stream of event ids."""
    ev = load(spark, sf_dir, "events").select("event_id")
    return _append_twin(spark, "double_even", ev, "event_id", lambda st: st.select(
        "event_id", doubled("event_id").alias("doubled")).filter(is_even("doubled")))


def q_stream_guarded_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guarded map on a stream: failure points quarantined, the stream keeps running."""
    ev = load(spark, sf_dir, "events").select("event_id")
    return _append_twin(spark, "guarded_double", ev, "event_id",
                        lambda st: guarded_double(st, "event_id"))


def q_stream_running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user running mean from keyed (count, total) value state."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return _append_twin(spark, "running_average", ev, "ts", lambda st: st.groupBy("user_id").transformWithState(
        statefulProcessor=RunningMean(["ts", "event_id"], ["event_id", "user_id", "value"], "value", scale=MONEY),
        outputStructType="event_id long, user_id long, value double, avg_value double",
        outputMode="Append", timeMode="None"))


def q_stream_arrival_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant key, 5 s windows of arrival time, update mode, folded per window."""
    landing, sink, ckpt = _paths(spark, "arrival_window_sum")
    events = load(spark, sf_dir, "events").select("ts")

    def start():
        stream = stream_table(spark, landing, schema=events.schema).select(
            F.col("ts").alias("arrival"), F.lit("key").alias("key"), F.lit(1).alias("n"))
        stream = event_time(stream, "arrival", "0 seconds")
        return upsert_batches(window_sum(stream, "arrival", ["key"], "n", "5 seconds"), sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    return _ntz(latest_rows(spark, sink, ["window_start", "key"]), "window_start", "window_end")


def q_stream_item_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand co-occurrence totals from streamed order lines.

    Order lines stream in and join the static part and orders tables; per
    customer, keyed state (grouped by a hash bucket of the customer) holds the brand
    counts; a bucket emits the batch's pair deltas (n'_a n'_b - n_a n_b) summed over
    its customers; the JVM sums them per pair per micro-batch (``additive_batches``);
    the co-occurrence is the sum.
    """
    landing, sink, ckpt = _paths(spark, "item_cooccurrence")
    buckets = pinned(spark, f"{ckpt}-buckets",
                     int(spark.conf.get("spark.sql.shuffle.partitions")) * WORD_BUCKETS_PER_PARTITION)
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")

    def start():
        stream = stream_table(spark, landing, schema=lineitem.schema)
        views = stream.join(part, "l_partkey").join(orders, "l_orderkey")
        deltas = (views.select(F.pmod(F.xxhash64("o_custkey"), F.lit(buckets)).alias("_bucket"),
                               F.col("o_custkey").cast("string").alias("user"), "p_brand")
                  .groupBy("_bucket").transformWithStateInPandas(
                      statefulProcessor=BucketedPairDeltas("user", "p_brand"),
                      outputStructType="item_a string, item_b string, inc long", outputMode="Append", timeMode="None"))
        return additive_batches(deltas.withColumnRenamed("inc", "cnt"), ["item_a", "item_b"], "cnt", sink, ckpt)

    run_in_slices(spark, lineitem, "l_orderkey", N_SLICES, landing, start)
    return sum_batches(spark, sink, ["item_a", "item_b"], "cnt")


_PAIR = ["item_a", "item_b"]


def q_stream_rolling_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chained keyed states: item history per user, then running totals per item pair."""
    landing, sink, ckpt = _paths(spark, "rolling_cooccurrence")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")

    def start():
        stream = stream_table(spark, landing, schema=events.schema)
        incs = stream.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=ItemHistory(["ts", "event_id"], "event_type", ["event_id", "ts", "user_id"]),
            outputStructType="event_id long, ts timestamp, user_id long, event_type string, "
                             "item_a string, item_b string, inc long",
            outputMode="Append", timeMode="None")
        finish(running_batches(incs, _PAIR, ["ts", "event_id"], sink, ckpt, weight="inc"))
        return carried_totals(spark, [incs.schema[c] for c in _PAIR], sink, f"{ckpt}-carried")

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    return _ntz(read_running(spark, _PAIR, sink), "ts")


def q_resumed_events(spark: SparkSession, sf_dir: str, n_slices: int = 2) -> DataFrame:
    """Labelled events ("Event-n") through a stream stopped and resumed between slices."""
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    landing, sink, ckpt = _paths(spark, "resumed_events")

    def start():
        stream = stream_table(spark, landing, schema=events.schema)
        return resumable_stream(stream.select("event_id", event_label("event_id").alias("label")), sink, ckpt)

    run_in_slices(spark, events, "event_id", n_slices, landing, start)
    return spark.read.schema("event_id long, label string").parquet(sink)


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("card"), F.col("value").alias("amount"),
        F.col("event_type").alias("location"), "ts", "event_id")


def _with_alert(pairs: DataFrame) -> DataFrame:
    millis = lambda c: F.unix_millis(F.col(c))
    return pairs.withColumn("alert", fraud_text("card", "first_amount", "first_location", millis("first_ts"),
                                                "second_amount", "second_location", millis("second_ts")))


# The test streams out of order: a row arrives up to an hour after its time.
DISORDER = "event_id * 7919 % 3600"


def q_stream_fraud_pairs_disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card pattern over rows that arrive up to an hour out of order: buffered and matched in event time."""
    landing, sink, ckpt = _paths(spark, "fraud_disordered")
    cards = _cards(spark, sf_dir)
    late_us = F.unix_micros(F.col("ts").cast("timestamp")) + F.expr(f"{DISORDER} * 1000000")
    rows = cards.withColumn("_us", late_us)
    rows = rows.withColumn("_slice", slice_number(rows, "_us", N_SLICES)).drop("_us")
    matcher = EventTimePairMatcher()

    def start():
        stream = until_end(stream_table(spark, landing, schema=cards.schema), "ts", "1 hour")
        pairs = timed(stream, "ts", "card", "amount", "location", "event_id").groupBy("card").transformWithStateInPandas(
            statefulProcessor=matcher, outputStructType=matcher.schema(T.LongType()), outputMode="Append", timeMode="EventTime")
        return resumable_stream(pairs, sink, ckpt)

    land_slices(spark, rows, "_slice", N_SLICES, landing, start)
    end_input(spark, landing, cards.schema, "ts")
    finish(start())
    pairs = spark.read.schema(matcher.schema(T.LongType())).parquet(sink).filter("output = 'pair'").drop("output")
    return _ntz(_with_alert(pairs), "first_ts", "second_ts")


# Every tenth row of the late-row query arrives 1 to 4 days after its time, beyond the delay.
LATE_DELAY, LATE_WINDOW_MS, LATE_SLICES = "6 hours", 3_600_000, 4
LATE_ARRIVAL = "CASE WHEN event_id % 10 = 3 THEN (event_id % 4 + 1) * 86400 ELSE 0 END"


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream with late rows, and the rows it drops as a second, labelled output."""
    landing, sink, ckpt = _paths(spark, "late_rows")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    rows = events.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")) + F.expr(f"({LATE_ARRIVAL}) * 1000000"))
    rows = rows.withColumn("_slice", slice_number(rows, "_us", LATE_SLICES)).drop("_us")
    windows = TimedWindows(Count(), ["event_id"], [("event_type", "string"), ("_salt", "int")], LATE_WINDOW_MS,
                           carry=[("event_id", "long"), (TIME, "long")])
    merged = TimedWindows(Count(), [], [("event_type", "string")], LATE_WINDOW_MS, carry=windows.carry)

    def start():
        stream = until_end(stream_table(spark, landing, schema=events.schema), "ts", LATE_DELAY)
        fired = windowed(timed(stream, "ts", "event_id", "event_type"), ["event_type"], windows, salt="event_id")
        return fired_windows(fired, merged, "cnt long", sink, ckpt)

    land_slices(spark, rows, "_slice", LATE_SLICES, landing, start)
    end_input(spark, landing, events.schema, "ts")
    finish(start())
    none = lambda kind: F.lit(None).cast(kind)
    kept = read_fired(spark, sink, "windows").select(F.lit("window").alias("output"), "event_type", "window_start", "window_end",
                                                     "cnt", none("long").alias("event_id"), none("timestamp").alias("ts"))
    late = read_fired(spark, sink, "late").select(F.lit("late").alias("output"), "event_type", none("timestamp").alias("window_start"),
                                                  none("timestamp").alias("window_end"), none("long").alias("cnt"), "event_id",
                                                  F.timestamp_micros(TIME).alias("ts"))
    return _ntz(kept.unionByName(late), "window_start", "window_end", "ts")


def q_stream_processing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted per window of the time they are processed; every window is emitted once, by its timer.

    The windows themselves depend on the clock, so the result is what does not: per
    type the sum over all windows, and how many windows came out more than once.
    """
    landing, sink, ckpt = _paths(spark, "processing_windows")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    windows = TimedWindows(Count(), ["event_id"], [("event_type", "string"), ("_salt", "int")], 1000, processing=True)
    merged = TimedWindows(Count(), [], [("event_type", "string")], 1000, processing=True)
    bounds, landed = slice_bounds(events, "ts", N_SLICES), 0
    events.limit(0).write.mode("append").parquet(landing)
    fired = windowed(stream_table(spark, landing, schema=events.schema).select("event_id", "event_type"), ["event_type"], windows,
                     salt="event_id")
    query = fired_windows(fired, merged, "total long", sink, ckpt, processing_time="1 second")
    try:
        seen: dict[int, dict] = {}
        for i in range(len(bounds) + 1):
            some = events.filter(slice_filter("ts", bounds, i))
            landed += some.count()
            some.write.mode("append").parquet(landing)
            _until(query, seen, lambda last: sum(p["numInputRows"] for p in seen.values()) >= landed)
        _until(query, seen, lambda last: all(o["numRowsTotal"] == 0 for o in last["stateOperators"]))
    finally:
        query.stop()
    out = read_fired(spark, sink, "windows")
    once = out.groupBy("event_type", "window_start").agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("times"))
    return once.groupBy("event_type").agg(F.sum("total").alias("total"),
                                          F.sum((F.col("times") > 1).cast("long")).alias("repeated_windows"))


def _until(query, seen: dict, done, seconds: float = 120.0) -> None:
    """Watch a running query's progress (kept per batch in ``seen``) until ``done`` holds for its last batch."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        seen.update({p["batchId"]: p for p in query.recentProgress})
        if seen and done(seen[max(seen)]):
            return
        time.sleep(0.2)
    raise TimeoutError("the stream did not come to its end")


def q_stream_behavior_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent user per type and day, by a user-defined accumulator in event-time windows."""
    landing, sink, ckpt = _paths(spark, "behavior_mode")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    day = 86_400_000
    windows = TimedWindows(Mode(), ["user_id"], [("event_type", "string"), ("_salt", "int")], day)
    merged = TimedWindows(Mode(), [], [("event_type", "string")], day)

    def start():
        stream = until_end(stream_table(spark, landing, schema=events.schema), "ts", "2 seconds")
        fired = windowed(timed(stream, "ts", "event_id", "event_type", "user_id"), ["event_type"], windows, salt="event_id")
        return fired_windows(fired, merged, MODE_RESULT, sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    end_input(spark, landing, events.schema, "ts")
    finish(start())
    return _ntz(read_fired(spark, sink, "windows").drop("batch_id", "window_end"), "window_start")


def q_stream_closed_event_time_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time counts in append mode: the end of input closes the last windows too."""
    landing, sink, ckpt = _paths(spark, "closed_counts")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")

    def start():
        stream = until_end(stream_table(spark, landing, schema=events.schema), "ts", "2 seconds")
        return resumable_stream(window_count(stream, "ts", ["event_type"], "5 seconds"), sink, ckpt)

    run_in_slices(spark, events, "ts", N_SLICES, landing, start)
    end_input(spark, landing, events.schema, "ts")
    finish(start())
    return _ntz(spark.read.parquet(sink), "window_start", "window_end")


def q_stream_rebucketed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling word count stopped, and continued by a query with another number of state buckets."""
    landing, sink, ckpt = _paths(spark, "rebucketed")
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    cuts = slice_bounds(conv, "conv_id", 2)

    def start(part: int, buckets: int):
        stream = stream_table(spark, f"{landing}/{part}", schema=conv.schema)
        words = tokenize(stream, "text", keep=("conv_id", "turn"), with_position=True)
        carried = carried_counts(spark, f"{ckpt}/{part - 1}", "word", buckets).groupBy("_bucket") if part else None
        counted = (words.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
                   .groupBy("_bucket").transformWithStateInPandas(
                       statefulProcessor=BucketedRunningCounter("word", ["conv_id", "turn", "pos"], ["conv_id", "turn", "pos", "word"]),
                       outputStructType="conv_id long, turn long, pos int, word string, cnt long",
                       outputMode="Append", timeMode="None", initialState=carried))
        return resumable_stream(counted, f"{sink}/part={part}", f"{ckpt}/{part}")

    for part, buckets in enumerate((24, 56)[:len(cuts) + 1]):
        conv.filter(slice_filter("conv_id", cuts, part)).write.parquet(f"{landing}/{part}")
        finish(start(part, buckets))
    parts = [spark.read.parquet(f"{sink}/part={part}") for part in range(len(cuts) + 1)]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def q_stream_product_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales totals folded from the changelog that every trigger writes."""
    landing, sink, ckpt = _paths(spark, "product_changelog")
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")

    def start():
        stream = stream_table(spark, landing, schema=lineitem.schema)
        view = declare_sales_view(spark, stream, "kf_stream_sales_log")
        return changelog_batches(sales_per_product(spark, view, scale=MONEY), ["product_id"], "total_sales", sink, ckpt)

    run_in_slices(spark, lineitem, "l_orderkey", N_SLICES, landing, start)
    return folded(read_changes(spark, sink), ["product_id"], "total_sales")


STREAM_QUERIES = {
    "resumed_events": q_resumed_events,
    "stream_event_time_counts": q_stream_event_time_counts,
    "stream_running_event_count": q_stream_running_event_count,
    "stream_parity_counter": q_stream_parity_counter,
    "stream_fraud_pairs": q_stream_fraud_pairs,
    "stream_sales_changelog": q_stream_sales_changelog,
    "stream_windowed_word_count": q_stream_windowed_word_count,
    "stream_behavior_counts": q_stream_behavior_counts,
    "stream_rolling_word_count": q_stream_rolling_word_count,
    "stream_rolling_cooccurrence": q_stream_rolling_cooccurrence,
    "stream_product_sales": q_stream_product_sales,
    "stream_sliding_page_views": q_stream_sliding_page_views,
    "stream_traffic_alerts": q_stream_traffic_alerts,
    "stream_upper_map": q_stream_upper_map,
    "stream_double_even": q_stream_double_even,
    "stream_guarded_double": q_stream_guarded_double,
    "stream_running_average": q_stream_running_average,
    "stream_arrival_window_sum": q_stream_arrival_window_sum,
    "stream_item_cooccurrence": q_stream_item_cooccurrence,
    "stream_fraud_pairs_disordered": q_stream_fraud_pairs_disordered,
    "stream_late_rows": q_stream_late_rows,
    "stream_processing_windows": q_stream_processing_windows,
    "stream_behavior_mode": q_stream_behavior_mode,
    "stream_closed_event_time_counts": q_stream_closed_event_time_counts,
    "stream_rebucketed_word_count": q_stream_rebucketed_word_count,
    "stream_product_changelog": q_stream_product_changelog,
}
