"""Registered batch queries: each program of the reference mapped onto the test tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables.  Column names match the SQL oracles in
:mod:`keyflow.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions import (accepted, doubled, guarded_double, is_even, parse_behavior,
                               parse_behavior_json, parse_page_log, rejected, text_length,
                               tokenize, upper_text)
from keyflow.operators.accumulate import Mode, accumulate
from keyflow.operators.changelog import retract_changelog
from keyflow.operators.cooccur import cooccurrence, related_items, rolling_cooccurrence
from keyflow.operators.patterns import fraud_pairs
from keyflow.operators.running import parity_counter, running_average, running_count
from keyflow.operators.sql import register_sales_view, sales_per_product
from keyflow.operators.windows import event_time, page_alerts, page_views, window_count, window_sum
from keyflow.operators.wordcount import rolling_word_count, word_count
from keyflow.sources.tables import behavior_lines, load, page_log_lines

Query = Callable[[SparkSession, str], DataFrame]

# Event order of the events table: time, then id as the tie-breaker.
EVENT_ORDER = ["ts", "event_id"]
# Decimals of the amounts and values of the test tables.
MONEY = 2


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word totals over all document texts (lower-cased, split on whitespace)."""
    return word_count(load(spark, sf_dir, "documents", spread=True), "text")


def q_rolling_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word occurrence with its running total, conversations in (conv_id, turn, pos) order."""
    conv = load(spark, sf_dir, "conversations", spread=True)
    return rolling_word_count(conv, "text", ["conv_id", "turn"])


def q_windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the event-type lines per 5 s window of arrival time."""
    ev = load(spark, sf_dir, "events")
    words = tokenize(ev, "event_type", keep=("ts",))
    return window_count(words, "ts", ["word"], "5 seconds")


def q_text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (text, length) tuples before filtering."""
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", "text", text_length("text").alias("text_len"))


def q_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose UTF-16 length is at least 30, with the length."""
    return q_text_lengths(spark, sf_dir).filter(F.col("text_len") >= 30)


def q_upper_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names upper-cased."""
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", upper_text("p_name").alias("upper_name"))


def q_double_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids doubled, then kept when even."""
    ev = load(spark, sf_dir, "events")
    out = ev.select("event_id", doubled("event_id").alias("doubled"))
    return out.filter(is_even("doubled"))


def q_even_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even event ids, doubled: the filter before the map, which removes the odd half."""
    ev = load(spark, sf_dir, "events").filter(is_even("event_id"))
    return ev.select("event_id", doubled("event_id").alias("doubled"))


def q_event_time_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type per 5 s event-time window (2 s bounded disorder)."""
    ev = event_time(load(spark, sf_dir, "events"), "ts", "2 seconds")
    return window_count(ev, "ts", ["event_type"], "5 seconds")


def q_arrival_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of 1 per 5 s arrival window under the single key 'key'."""
    ev = load(spark, sf_dir, "events").select(F.col("ts").alias("arrival"),
                                              F.lit("key").alias("key"), F.lit(1).alias("n"))
    return window_sum(ev, "arrival", ["key"], "n", "5 seconds")


def q_running_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's running event count."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return running_count(ev, ["user_id"], EVENT_ORDER).drop("ts")


def q_running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's running mean value (exact decimal running sum)."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return running_average(ev, ["user_id"], EVENT_ORDER, "value", scale=MONEY).drop("ts")


def q_parity_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter per key event_id % 2 with the counter message."""
    ev = load(spark, sf_dir, "events").select("event_id")
    return parity_counter(ev, "event_id")


def q_guarded_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids doubled; positive multiples of ten quarantined instead of failing."""
    return guarded_double(load(spark, sf_dir, "events"), "event_id")


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("card"), F.col("value").alias("amount"),
        F.col("event_type").alias("location"), "ts", "event_id")


def q_fraud_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive small transactions of a card within 5 min at different places, with alert text."""
    return fraud_pairs(_cards(spark, sf_dir), order=EVENT_ORDER, id_col="event_id")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = page_log_lines(load(spark, sf_dir, "events", spread=True))
    return parse_page_log(lines, "line", keep=("arrival",))


def q_sliding_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed page-log lines counted per page in 10 s windows every 5 s."""
    return page_views(_pages(spark, sf_dir), "arrival", "10 seconds", "5 seconds")


# The reference alerts on > 100 views per page in 5 s; the test stream has at
# most 2 per 5 s, so the registered query uses 1 hour and > 5.
TRAFFIC_WINDOW, TRAFFIC_THRESHOLD = "1 hour", 5


def q_traffic_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages above the view threshold per tumbling window, with alert text."""
    return page_alerts(_pages(spark, sf_dir), "arrival", TRAFFIC_WINDOW, TRAFFIC_THRESHOLD)


def _brand_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, brand) per order line: lineitem ⋈ part ⋈ orders.

    The co-occurrence counts views per (customer, brand) right after the
    joins, so only partial aggregates cross the final shuffle; lineitem is
    shuffled once (by order key), and part goes by broadcast when AQE
    measures it small.
    """
    li = load(spark, sf_dir, "lineitem", spread=True).select("l_orderkey", "l_partkey")
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(part, "l_partkey").join(orders, "l_orderkey").select("o_custkey", "p_brand")


def q_item_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand pairs with the number of co-occurring views over customers."""
    return cooccurrence(_brand_views(spark, sf_dir), "o_custkey", "p_brand")


def q_related_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-3 related brands per brand by co-occurrence."""
    return related_items(q_item_cooccurrence(spark, sf_dir), k=3)


def q_rolling_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running pair totals as views arrive (one row per view and earlier item)."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return rolling_cooccurrence(ev, "user_id", "event_type", EVENT_ORDER)


def _behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_behavior(behavior_lines(load(spark, sf_dir, "events")), "line",
                          keep=("event_id", "variant"))


def _behavior_window_counts(ok: DataFrame) -> DataFrame:
    timed = event_time(ok, "event_ts", "5 seconds", millis_col="ts_ms")
    counts = window_count(timed, "event_ts", ["behavior_type"], "1 minute")
    # event time is TIMESTAMP (UTC); report window bounds as wall-clock NTZ
    return (counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
                  .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def q_behavior_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed CSV behaviour records counted per type per 1 min event-time window."""
    return _behavior_window_counts(accepted(_behaviors(spark, sf_dir)))


# Result of the mode accumulator: the smallest of the most frequent users, how many share that count, the count.
MODE_RESULT = "mode_user long, ties long, mode_cnt long"


def q_behavior_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent user per type and day, by a user-defined accumulator (partials, then a tree of merges)."""
    events = load(spark, sf_dir, "events").select("event_type", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"))
    return accumulate(events, ["event_type", "window_start"], Mode(), ["user_id"], MODE_RESULT)


def q_behavior_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour records the parser rejected, with the reason."""
    return rejected(_behaviors(spark, sf_dir)).select("event_id", "variant", "line", "reject_reason")


def q_behavior_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON behaviour records (plus the raw ``props`` JSON as malformed records)."""
    ev = load(spark, sf_dir, "events", spread=True)
    record = F.to_json(F.struct(F.col("user_id").cast("string").alias("userId"),
                                F.col("event_id").cast("string").alias("itemId"),
                                F.col("event_type").alias("behaviorType"),
                                F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")))
    values = ev.select("event_id", F.explode(F.array(record, F.col("props"))).alias("value"))
    parsed = parse_behavior_json(values, "value", keep=("event_id",))
    return _behavior_window_counts(accepted(parsed))


def q_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL: SUM(amount * price) per product over the declared sales view."""
    return sales_per_product(spark, register_sales_view(spark, sf_dir), scale=MONEY)


def q_sales_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retract changelog (-old, +new) of the running sales total per product."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("product_id"), "o_orderkey", "o_totalprice")
    return retract_changelog(orders, "product_id", ["o_orderkey"], "o_totalprice", scale=MONEY)


BATCH_QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "rolling_word_count": q_rolling_word_count,
    "windowed_word_count": q_windowed_word_count,
    "text_lengths": q_text_lengths,
    "length_filter": q_length_filter,
    "upper_map": q_upper_map,
    "double_even": q_double_even,
    "even_double": q_even_double,
    "event_time_counts": q_event_time_counts,
    "arrival_window_sum": q_arrival_window_sum,
    "running_event_count": q_running_event_count,
    "running_average": q_running_average,
    "parity_counter": q_parity_counter,
    "guarded_double": q_guarded_double,
    "fraud_pairs": q_fraud_pairs,
    "sliding_page_views": q_sliding_page_views,
    "traffic_alerts": q_traffic_alerts,
    "item_cooccurrence": q_item_cooccurrence,
    "related_items": q_related_items,
    "rolling_cooccurrence": q_rolling_cooccurrence,
    "behavior_counts": q_behavior_counts,
    "behavior_mode": q_behavior_mode,
    "behavior_rejects": q_behavior_rejects,
    "behavior_json": q_behavior_json,
    "product_sales": q_product_sales,
    "sales_changelog": q_sales_changelog,
}
