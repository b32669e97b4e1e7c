"""Running totals on streams whose keys may be few and hot (O-37, O-46, O-48).

A keyed state sees all rows of its key in one task, in no order.  With a handful of
keys (parities, item pairs) that task would sort a large part of every micro-batch in
Python.  So the work is split: :func:`running_batches` writes each micro-batch with
the running sums inside the batch, by the skew-safe scan that cuts a hot key into
chunks, and one total per key; :func:`carried_totals` streams those totals through the
keyed state (:class:`RunningCounter`), which thus sees one row per key and batch;
:func:`read_running` adds what the key had before its batch.

Folders are named by the batch, and a batch run again overwrites its own; start
:func:`carried_totals` when :func:`running_batches` has ended, as it reads a folder once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyflow.operators.scan import running_sums
from keyflow.sources.streams import stream_table
from keyflow.streaming.resume import resumable_stream
from keyflow.streaming.stateful import RunningCounter


def running_batches(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sink: str, checkpoint: str,
                    weight: str | None = None, rows_per_chunk: int | None = None) -> StreamingQuery:
    """Write each micro-batch's rows with ``cnt``, the running count (sum of ``weight``) of their key in this batch."""
    keys, order = list(keys), list(order)
    measure = F.col(weight) if weight else F.lit(1)

    def write(batch: DataFrame, batch_id: int) -> None:
        arrived = f"{sink}/arrived/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(arrived)  # a stateful operator before runs once
        some = batch.sparkSession.read.schema(batch.schema).parquet(arrived)
        running_sums(some, keys, order, {"cnt": measure}, rows_per_chunk=rows_per_chunk).write.mode("overwrite").parquet(
            f"{sink}/within/batch_id={batch_id}")
        some.groupBy(*keys).agg(F.sum(measure).cast("long").alias("n")).write.mode("overwrite").parquet(
            f"{sink}/totals/batch_id={batch_id}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def carried_totals(spark: SparkSession, keys: Sequence[T.StructField], sink: str, checkpoint: str) -> StreamingQuery:
    """Stream the batches' totals through each key's counter: ``upto``, its total after the batch."""
    names, batch = [f.name for f in keys], T.StructField("batch_id", T.LongType())
    fields = [*keys, T.StructField("n", T.LongType()), batch]
    totals = stream_table(spark, f"{sink}/totals", schema=T.StructType(fields))
    carried = totals.groupBy(*names).transformWithState(
        statefulProcessor=RunningCounter(["batch_id"], [*names, "n", "batch_id"], count="upto", weight="n"),
        outputStructType=T.StructType([*fields, T.StructField("upto", T.LongType())]), outputMode="Append", timeMode="None")
    return resumable_stream(carried, f"{sink}/carried", checkpoint)


def read_running(spark: SparkSession, keys: Sequence[str], sink: str) -> DataFrame:
    """All rows, with ``cnt`` over all batches."""
    key = F.struct(*[F.col(k) for k in keys])  # struct equality takes nulls as equal
    within = spark.read.parquet(f"{sink}/within")
    columns = [c for c in within.columns if c not in ("cnt", "batch_id")]
    before = spark.read.parquet(f"{sink}/carried").select(key.alias("_kf_key"), F.col("batch_id").cast("long").alias("_kf_batch"),
                                                          (F.col("upto") - F.col("n")).alias("_kf_before"))
    rows = within.withColumns({"_kf_key": key, "_kf_batch": F.col("batch_id").cast("long")})
    return rows.join(before, ["_kf_key", "_kf_batch"]).select(*columns, (F.col("cnt") + F.col("_kf_before")).cast("long").alias("cnt"))
