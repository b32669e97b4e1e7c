"""Time windows: tumbling and sliding keyed aggregates, thresholds, watermarks.

The same functions serve batch and streaming frames.  On a stream,
:func:`event_time` sets the watermark; in batch the input is bounded and all
windows are final (the end of input closes every window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.formats import alert_text


def event_time(df: DataFrame, ts: str, max_delay: str = "2 seconds",
               millis_col: str | None = None) -> DataFrame:
    """Assign event time (optionally from epoch millis) and, on streams, a watermark.

    ``max_delay`` is the bounded out-of-orderness; ``"0 seconds"`` is the
    monotonous-timestamps strategy.
    """
    if millis_col is not None:
        df = df.withColumn(ts, F.timestamp_millis(F.col(millis_col)))
    if df.isStreaming:
        df = df.withWatermark(ts, max_delay)
    return df


def arrival_time(df: DataFrame, col: str = "arrival") -> DataFrame:
    """Processing-time attribute: the time a row is seen (``PROCTIME()``)."""
    return df.withColumn(col, F.current_timestamp())


def _flatten(df: DataFrame, keys: Sequence[str], aggs: Sequence[str]) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *keys, *aggs)


def window_aggregate(df: DataFrame, ts: str, keys: Sequence[str], aggs: dict[str, Column],
                     size: str, slide: str | None = None) -> DataFrame:
    """Keyed tumbling (``slide=None``) or sliding window aggregate.

    Output columns: ``window_start, window_end, *keys, *aggs``.  Partial
    aggregation runs before the shuffle; a sliding window copies each row
    into ``size / slide`` windows first.
    """
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(win.alias("window"), *keys).agg(
        *[expr.alias(name) for name, expr in aggs.items()])
    return _flatten(grouped, list(keys), list(aggs))


def window_count(df: DataFrame, ts: str, keys: Sequence[str], size: str,
                 slide: str | None = None, count: str = "cnt") -> DataFrame:
    return window_aggregate(df, ts, keys, {count: F.count(F.lit(1))}, size, slide)


def window_sum(df: DataFrame, ts: str, keys: Sequence[str], value: str | Column, size: str,
               slide: str | None = None, total: str = "total") -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return window_aggregate(df, ts, keys, {total: F.sum(v)}, size, slide)


def threshold_alerts(counts: DataFrame, key: str, count: str = "cnt", threshold: int = 100,
                     message: str = "alert") -> DataFrame:
    """Rows whose window count exceeds ``threshold`` (strict), with the alert text."""
    return (counts.filter(F.col(count) > threshold)
                  .withColumn(message, alert_text(key, count)))


def page_views(pages: DataFrame, ts: str = "arrival", size: str = "10 seconds",
               slide: str | None = "5 seconds") -> DataFrame:
    """Sliding page-view counts (10 s every 5 s by default)."""
    return window_count(pages, ts, ["page"], size, slide)


def page_alerts(pages: DataFrame, ts: str = "arrival", size: str = "5 seconds",
                threshold: int = 100) -> DataFrame:
    """Tumbling page-view counts above ``threshold``, with the alert text."""
    return threshold_alerts(window_count(pages, ts, ["page"], size), "page", "cnt", threshold)
