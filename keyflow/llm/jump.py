"""Sharding by jump consistent hashing (operator 9).

A stable key is hashed to 64 bits and jumps through the shard numbers: from
shard b it jumps to ``(b + 1) / r`` with r drawn from the key's own linear
congruential sequence, until the jump leaves the range.  There is no ring
table; when a shard is appended, a key either stays or moves into the new one,
and the needed fraction 1/(n + 1) moves.

Rows keep their order of reading within a shard: ``slot`` counts the shard's
rows gaplessly from 0.  Slots are row numbers within bounded chunks of a shard
plus the sizes of the chunks before, so a shard is never gathered in one task.

Defined cases: a null key is a key of its own (all its rows share a shard);
equal keys share a shard; repeated rows each get a slot; a null text has no
bytes; an empty table gives an empty result; added columns replace columns of
the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import numbered, table, with_columns

SHARDS = 24
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        state[active] = state[active] * MULTIPLIER + np.uint64(1)
        spread = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead = ((at[active] + 1) * (2147483648.0 / spread)).astype(np.int64)
        inside = ahead < shards
        active = active[inside]
        at[active] = ahead[inside]
    return at.astype(np.int32)


def sharded(df: DataFrame, key: str | list[str], shards: int = SHARDS, shard: str = "shard",
            grown: str = "grown_shard") -> DataFrame:
    """Append the row's shard among ``shards``, and among one more."""
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_kf_hash", F.xxhash64(*[F.col(f"`{k}`") for k in keys]))
    added = T.StructType([T.StructField(shard, T.IntegerType()), T.StructField(grown, T.IntegerType())])

    def make():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            return [pa.array(jump(values, shards)), pa.array(jump(values, shards + 1))]
        return step

    return with_columns(hashed, ["_kf_hash"], added, make).drop("_kf_hash")


def with_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Append each row's place within its shard, gapless from 0."""
    return numbered(df, [shard], slot)


def write_shards(df: DataFrame, key: str | list[str], path: str, shards: int = SHARDS) -> None:
    """Write the rows as Parquet, one folder per shard."""
    sharded(df, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)


def op9_shards(spark, sf_dir):
    """All documents in 24 shards under the law ``key``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return with_slots(sharded(docs, "doc_id").withColumn("law", F.lit("key"))).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
