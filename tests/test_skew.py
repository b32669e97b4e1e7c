"""The skew claims: no (key, chunk) window partition outgrows rows_per_chunk, whatever the key spread."""

import pytest
from pyspark.sql import functions as F

from keyflow.operators.scan import CHUNK, add_chunks


@pytest.mark.parametrize("n_keys", [2, 1000])
def test_hot_key_is_split_into_bounded_chunks(spark, n_keys):
    n, rows_per_chunk = 30_000, 1_000
    # one key holds a third of all rows; the rest spread over n_keys keys
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % n_keys).alias("key"),
        F.col("id").alias("t"))
    chunked, did = add_chunks(df, "t", rows_per_chunk)
    assert did
    sizes = chunked.groupBy("key", CHUNK).count()
    biggest = sizes.agg(F.max("count")).first()[0]
    hot_chunks = sizes.filter(F.col("key") == -1).count()
    assert biggest <= 1.5 * rows_per_chunk
    assert hot_chunks >= (n // 3) // rows_per_chunk


def test_bursty_time_still_gives_bounded_chunks(spark):
    # 90% of the rows fall into 1% of the time range: quantile cuts follow the data
    n, rows_per_chunk = 20_000, 1_000
    df = spark.range(n).select(
        F.lit("hot").alias("key"),
        F.when(F.col("id") % 10 < 9, F.col("id") / 1000.0).otherwise(F.col("id") * 100.0).alias("t"))
    chunked, _ = add_chunks(df, "t", rows_per_chunk)
    biggest = chunked.groupBy("key", CHUNK).count().agg(F.max("count")).first()[0]
    assert biggest <= 1.5 * rows_per_chunk
