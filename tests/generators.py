"""Generated inputs of the demo programs, expressed as Spark sources (O-5..O-9).

The reference drives several programs from paced in-process generators.
Here the same rows come from ``spark.range`` (bounded, deterministic) or the
``rate`` source (unbounded, offsets checkpointed).  They serve tests and
demos; the registered queries read the test tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.formats import event_label

# The disorder demo cycles three event names and pulls every
# third-of-cycle event back by 2 s per step (time = base + c s - (c % 3) * 2 s).
DEMO_EVENT_NAMES = ("eventA", "eventB", "eventC")


def disordered_events(spark: SparkSession, n: int = 15,
                      base: dt.datetime = dt.datetime(2024, 1, 1)) -> DataFrame:
    """(name, ts_ms, ts): ``n`` events whose event time runs up to 2 s out of order."""
    names = F.array(*[F.lit(x) for x in DEMO_EVENT_NAMES])
    base_ms = int(base.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    c = F.col("id")
    ts_ms = F.lit(base_ms) + c * 1000 - (c % 3) * 2000
    return spark.range(n).select(
        F.element_at(names, (c % len(DEMO_EVENT_NAMES) + 1).cast("int")).alias("name"),
        ts_ms.alias("ts_ms"), F.timestamp_millis(ts_ms).alias("ts"))


def constant_key_stream(rate: DataFrame) -> DataFrame:
    """("key", 1) per generated row, timestamped by the generator (O-6)."""
    return rate.select(F.lit("key").alias("key"), F.lit(1).alias("n"),
                       F.col("timestamp").alias("arrival"))


def labelled_counter(rate: DataFrame) -> DataFrame:
    """"Event-n" for the counter n = 0, 1, 2, ... (O-7)."""
    return rate.select(F.col("value").alias("n"), event_label("value").alias("label"))


def counter(rate: DataFrame) -> DataFrame:
    """The bare counter 0, 1, 2, ... (O-8); offsets make it replayable."""
    return rate.select(F.col("value").alias("n"), F.col("timestamp").alias("arrival"))


def generated_orders(spark: SparkSession, n: int, seed: int = 7, products: int = 3) -> DataFrame:
    """Random orders like the declared generator table (O-9).

    ``order_id`` 10 characters, ``product_id`` "1".."products" (as text),
    ``amount`` 1..5, ``price`` 10..100, ``proc_time`` = processing time.
    """
    return spark.range(n).select(
        F.substring(F.sha2(F.concat(F.lit(str(seed)), F.col("id").cast("string")), 256), 1, 10)
        .alias("order_id"),
        (F.floor(F.rand(seed) * products) + 1).cast("int").cast("string").alias("product_id"),
        (F.floor(F.rand(seed + 1) * 5) + 1).cast("int").alias("amount"),
        F.round(F.rand(seed + 2) * 90 + 10, 2).alias("price"),
        F.current_timestamp().alias("proc_time"))
