"""Streaming readers: file streams over parquet/text, rate, Kafka and socket options.

All readers declare their schema.  Event-time columns stored as TIMESTAMP_NTZ
are cast to TIMESTAMP (session time zone UTC) because watermarks require it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.sources.tables import SCHEMAS


def stream_table(spark: SparkSession, path: str, name: str | None = None,
                 schema: T.StructType | None = None, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None,
                 event_time_cols: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Parquet files under ``path`` as an unbounded stream (replayable, offsets checkpointed).

    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound each
    micro-batch, and with it the rows of one key that a stateful task sees.
    """
    schema = schema or SCHEMAS[name]
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    df = reader.load(path)
    for c in event_time_cols:
        if c in df.columns and isinstance(schema[c].dataType, T.TimestampNTZType):
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (``value``) arriving as files, with an arrival timestamp."""
    return (spark.readStream.format("text").load(path)
            .withColumn("arrival", F.current_timestamp()))


def rate_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Counter stream 0,1,2,... with a generation timestamp (``value``, ``timestamp``)."""
    return (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load())


def micro_batch_rate(spark: SparkSession, rows_per_batch: int = 1, advance_ms: int = 1000,
                     start_ms: int = 0) -> DataFrame:
    """Deterministic counter stream: each micro-batch adds ``rows_per_batch`` rows and
    moves the generated ``timestamp`` by ``advance_ms`` (replayable, for tests and demos)."""
    return (spark.readStream.format("rate-micro-batch")
            .option("rowsPerBatch", str(rows_per_batch))
            .option("advanceMillisPerBatch", str(advance_ms))
            .option("startTimestamp", str(start_ms)).load())


def kafka_options(servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest") -> dict[str, str]:
    """Reader options for ``readStream.format("kafka")`` (connector jar supplied by the cluster)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_values(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Value-only string records from Kafka, as the behaviour program consumes them."""
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kw)).load()
            .selectExpr("CAST(value AS STRING) AS value"))


def socket_options(host: str, port: int) -> dict[str, str]:
    """Reader options for ``readStream.format("socket")`` (lines in column ``value``)."""
    return {"host": host, "port": str(port)}
