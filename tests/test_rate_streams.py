"""Generated streams (O-6..O-8), processing-time windows (O-40), the failing map (O-24)."""

import time

import pytest

from keyflow.functions import guarded_double, guarded_double_strict
from keyflow.operators import window_sum
from keyflow.session import shared_path
from generators import constant_key_stream, counter, labelled_counter
from keyflow.sources import micro_batch_rate


def run_batches(query, n_batches: int, timeout: float = 60.0):
    deadline = time.time() + timeout
    while time.time() < deadline and query.isActive:
        progress = query.lastProgress
        if progress and progress["batchId"] >= n_batches - 1:
            break
        time.sleep(0.2)
    query.stop()


def test_processing_time_window_sum_fixture_a8(spark):
    ckpt = shared_path(spark, "tests", "rate_window", fresh=True)
    keyed = constant_key_stream(micro_batch_rate(spark, 1, 1000)).withWatermark("arrival", "0 seconds")
    sums = window_sum(keyed, "arrival", ["key"], "n", "5 seconds")
    q = (sums.writeStream.format("memory").queryName("kf_rate_window").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(processingTime="0 seconds").start())
    run_batches(q, 13)
    got = sorted((r.window_start.second, r.total) for r in spark.sql("SELECT * FROM kf_rate_window").collect())
    assert got[:2] == [(0, 5), (5, 5)]


def test_labelled_counter_fixture_a11(spark):
    ckpt = shared_path(spark, "tests", "rate_labels", fresh=True)
    q = (labelled_counter(micro_batch_rate(spark, 3)).writeStream.format("memory")
         .queryName("kf_rate_labels").option("checkpointLocation", ckpt)
         .trigger(processingTime="0 seconds").start())
    run_batches(q, 3)
    rows = {r.n: r.label for r in spark.sql("SELECT * FROM kf_rate_labels").collect()}
    assert all(rows[n] == f"Event-{n}" for n in range(9))


def test_strict_guarded_map_fails_the_stream_quarantine_does_not(spark):
    strict = counter(micro_batch_rate(spark, 3)).select(guarded_double_strict("n").alias("d"))
    q = (strict.writeStream.format("memory").queryName("kf_rate_strict")
         .option("checkpointLocation", shared_path(spark, "tests", "rate_strict", fresh=True))
         .trigger(processingTime="0 seconds").start())
    with pytest.raises(Exception, match="Simulated failure at count: 10"):
        q.awaitTermination(90)

    safe = guarded_double(counter(micro_batch_rate(spark, 3)), "n")
    q = (safe.writeStream.format("memory").queryName("kf_rate_safe")
         .option("checkpointLocation", shared_path(spark, "tests", "rate_safe", fresh=True))
         .trigger(processingTime="0 seconds").start())
    run_batches(q, 5)
    rows = {r.n: (r.doubled, r.quarantined) for r in spark.sql("SELECT * FROM kf_rate_safe").collect()}
    assert rows[10] == (None, True) and rows[11] == (22, False) and rows[0] == (0, False)
