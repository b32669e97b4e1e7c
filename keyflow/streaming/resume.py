"""Resumable, exactly-once streams (O-63, O-64).

A query's progress lives in its checkpoint folder (source offsets, commit
log, state store).  Restarting with the same checkpoint and the same query
shape continues where the last run stopped: files already committed are not
read again, keyed state is restored, and the file sink's metadata log keeps
every output row exactly once.  Checkpoints and sinks live under the shared
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery



def resumable_stream(df: DataFrame, sink: str, checkpoint: str, output_mode: str = "append",
                     available_now: bool = True, processing_time: str = "10 seconds",
                     fmt: str = "parquet") -> StreamingQuery:
    """Start ``df`` into a file sink with a checkpoint; exactly once across restarts.

    ``available_now`` drains what is there and stops (batch-like runs on a
    schedule); otherwise a micro-batch runs every ``processing_time``.
    """
    writer = (df.writeStream.format(fmt).outputMode(output_mode)
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()


def upsert_batches(df: DataFrame, sink: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Update-mode output written per micro-batch to ``sink/batch_id=<id>``.

    Re-running a batch after a failure overwrites its own folder, so the sink
    stays exactly once; :func:`latest_rows` folds the updates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer: DataStreamWriter = (df.writeStream.outputMode("update").foreachBatch(write)
                                .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()


def additive_batches(df: DataFrame, keys: Sequence[str], value: str, sink: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Per-micro-batch partial sums of ``value`` per key, written to ``sink/batch_id=<id>``.

    For additive results (totals): each batch is reduced in the JVM to one
    row per key, a retried batch overwrites its own folder (exactly once),
    and :func:`sum_batches` folds the partial sums.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(*keys).agg(F.sum(value).alias(value))
              .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()


def sum_batches(spark: SparkSession, sink: str, keys: Sequence[str], value: str) -> DataFrame:
    """Totals from an :func:`additive_batches` sink."""
    return spark.read.parquet(sink).groupBy(*keys).agg(F.sum(value).alias(value))


def latest_rows(spark: SparkSession, sink: str, keys: Sequence[str], schema: str | None = None) -> DataFrame:
    """Last update per key (null keys included) from an :func:`upsert_batches` sink."""
    reader = spark.read.schema(schema) if schema else spark.read
    return latest_of(reader.parquet(sink), keys)


def latest_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row with the largest ``batch_id`` per key, without that column."""
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_kf_last"))
    return latest.select(*[c if c in keys else F.col(f"_kf_last.{c}").alias(c)
                           for c in rows.columns if c != "batch_id"])


def pinned(spark: SparkSession, path: str, value: int) -> int:
    """The number kept at ``path``, which the first call sets to ``value``.

    For numbers that are part of a state's key (hash buckets): a restart with
    other session settings must go on with the number of the first start.
    """
    try:
        return spark.read.schema("n long").parquet(path).first()["n"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.range(1).select(F.lit(value).cast("long").alias("n")).coalesce(1).write.parquet(path)
    return value


def read_state(spark: SparkSession, checkpoint: str, state_var: str | None = None,
               operator_id: int = 0) -> DataFrame:
    """Inspect a query's keyed state from its checkpoint (the ``statestore`` source).

    ``state_var`` names a ``transformWithState`` variable (e.g. ``"count"``).
    """
    reader = spark.read.format("statestore").option("operatorId", str(operator_id))
    if state_var:
        reader = reader.option("stateVarName", state_var)
    return reader.load(checkpoint)
