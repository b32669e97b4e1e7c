"""Null measures, order values and group keys are neither lost nor change a result with the chunk size."""

import pytest
from pyspark.sql import functions as F

from keyflow.operators.running import running_average
from keyflow.plans.landing import slice_filter
from keyflow.session import shared_path
from keyflow.sources.streams import stream_table
from keyflow.streaming.resume import latest_rows, pinned, resumable_stream
from keyflow.streaming.stateful import RunningMean


@pytest.mark.parametrize("chunk", [3, 5, 97])
def test_running_average_with_nulls_is_the_same_in_chunks(spark, chunk):
    rows = [(1, t, None if t in (1, 5, 6) else float(t)) for t in range(1, 11)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    plain = running_average(df, ["k"], ["t"], "v", scale=0, rows_per_chunk=1000)
    cut = running_average(df, ["k"], ["t"], "v", scale=0, rows_per_chunk=chunk)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, cut.collect()), key=repr)


def test_slices_hold_every_row_once(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "t int")
    for bounds in ([], [2], [2, 4]):
        parts = [df.filter(slice_filter("t", bounds, i)) for i in range(len(bounds) + 1)]
        assert sum(p.count() for p in parts) == 5
    assert df.filter(slice_filter("t", [2], 0)).filter(F.col("t").isNull()).count() == 1


def test_last_update_keeps_null_keys(spark, tmp_path):
    path = str(tmp_path / "sink")
    spark.createDataFrame([(None, 1, 0), (None, 3, 1), ("a", 2, 0)], "k string, cnt int, batch_id long").write.parquet(path)
    assert sorted(map(tuple, latest_rows(spark, path, ["k"]).collect()), key=repr) == [("a", 2), (None, 3)]


def test_streamed_mean_with_nulls_equals_batch(spark):
    base = shared_path(spark, "tests", "mean", fresh=True)
    rows = [(k, t, None if t in (1, 5, 6) else round(0.0035 * t, 4)) for k in (1, None) for t in range(1, 11)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    for some in (df.filter("t <= 1"), df.filter("t between 2 and 5"), df.filter("t > 5")):
        some.write.mode("append").parquet(f"{base}/in")
        means = stream_table(spark, f"{base}/in", schema=df.schema).groupBy("k").transformWithState(
            statefulProcessor=RunningMean(["t"], ["k", "t", "v"], "v", scale=4),
            outputStructType="k int, t int, v double, avg_value double", outputMode="Append", timeMode="None")
        resumable_stream(means, f"{base}/out", f"{base}/ckpt").awaitTermination()
    want = running_average(df, ["k"], ["t"], "v", scale=4)
    got = spark.read.parquet(f"{base}/out").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_pinned_number_outlives_its_setting(spark):
    path = shared_path(spark, "tests", "pinned", fresh=True)
    assert [pinned(spark, path, 32), pinned(spark, path, 80)] == [32, 32]
