"""The retract changelog of a continuously updated result, per trigger (O-13, O-54).

A streaming aggregate in update mode gives the totals that a micro-batch changed.
``foreachBatch`` compares them, null-safely, with the totals before: a key that was
not there adds ``+ total``; a changed one retracts ``- old`` and adds ``+ new``; an
unchanged one gives nothing.  Folding the changelog (+ adds, - removes) after any
trigger gives the totals at that trigger.

Totals before a batch are the newest update of each key over the batches since the
last snapshot, and that snapshot; a snapshot of all totals is written every
``SNAPSHOT`` batches, so a trigger writes what it changed and reads a bounded number
of versions.  Folders are named by the batch, and a batch run again overwrites its
own, so the changelog has every change once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyflow.streaming.resume import latest_of

#: Batches between two snapshots of all totals.
SNAPSHOT = 32


def changes(before: DataFrame, updates: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """(keys, op, seq, total): what leads from ``before`` to the updated totals; null keys and totals are values."""
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")  # struct equality takes nulls as equal
    old = before.select(key, F.struct(F.col(total).alias("v")).alias("old"))
    new = updates.select(key, F.struct(F.col(total).alias("v")).alias("new"))
    # keys without an update did not change: of the full outer join only the updated side can differ
    met = new.join(old, "_key", "left").filter(F.col("old").isNull() | ~F.col("old.v").eqNullSafe(F.col("new.v")))
    retract = F.when(F.col("old").isNotNull(), F.struct(F.lit("-").alias("op"), F.lit(0).alias("seq"), F.col("old.v").alias("v")))
    add = F.struct(F.lit("+").alias("op"), F.lit(1).alias("seq"), F.col("new.v").alias("v"))
    rows = met.select("_key", F.explode(F.filter(F.array(retract, add), lambda e: e.isNotNull())).alias("e"))
    return rows.select(*[F.col(f"_key.{k}").alias(k) for k in keys], "e.op", "e.seq", F.col("e.v").alias(total))


def _totals(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """All totals before a batch: the last snapshot before it, and the updates since."""
    base = max(0, batch_id - 1) // SNAPSHOT * SNAPSHOT
    versions = [spark.read.schema(schema).parquet(f"{folder}/updates/batch_id={v}").withColumn("batch_id", F.lit(v).cast("long"))
                for v in range(base, batch_id)]
    if base > 0:
        versions[0] = spark.read.schema(schema).parquet(f"{folder}/snapshots/batch_id={base}").withColumn(
            "batch_id", F.lit(base).cast("long"))
    if not versions:
        return spark.createDataFrame([], schema)
    rows = versions[0]
    for more in versions[1:]:
        rows = rows.unionByName(more)
    return latest_of(rows, keys)


def changelog_batches(totals: DataFrame, keys: Sequence[str], total: str, folder: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """Start an update-mode query whose changelog is written to ``folder/changes/batch_id=<id>``."""
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.select(*keys, total).schema
        batch.select(*keys, total).write.mode("overwrite").parquet(f"{folder}/updates/batch_id={batch_id}")
        updates = spark.read.schema(schema).parquet(f"{folder}/updates/batch_id={batch_id}")
        before = _totals(spark, folder, batch_id, schema, keys)
        changes(before, updates, keys, total).write.mode("overwrite").parquet(f"{folder}/changes/batch_id={batch_id}")
        if batch_id and batch_id % SNAPSHOT == 0:
            both = before.withColumn("batch_id", F.lit(0).cast("long")).unionByName(updates.withColumn("batch_id", F.lit(1).cast("long")))
            latest_of(both, keys).write.mode("overwrite").parquet(f"{folder}/snapshots/batch_id={batch_id}")

    writer = totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The whole changelog, with the batch of each change."""
    return spark.read.option("basePath", f"{folder}/changes").parquet(f"{folder}/changes")


def folded(log: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """The totals that a changelog leads to: of each key the last added one."""
    added = log.filter("op = '+'").select(*keys, total, "batch_id")
    return latest_of(added, keys)
