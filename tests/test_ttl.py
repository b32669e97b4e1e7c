"""Time-bounded item history: state TTL under a processing-time trigger."""

import time

from pyspark.sql import types as T
from keyflow.session import shared_path
from keyflow.sources.streams import stream_table
from keyflow.streaming.stateful import ItemHistory


def wait_rows(q, n_inputs, timeout=60):
    deadline = time.time() + timeout
    while time.time() < deadline:
        done = sum(p["numInputRows"] for p in q.recentProgress)
        if done >= n_inputs:
            return
        time.sleep(0.3)
    raise AssertionError("stream did not catch up")


def test_item_history_ttl_forgets_old_items(spark):
    base = shared_path(spark, "tests", "ttl", fresh=True)
    schema = "seq long, u string, item string"
    spark.createDataFrame([], schema).write.parquet(f"{base}/in")
    st = stream_table(spark, f"{base}/in", schema=T.StructType.fromDDL(schema))
    out = st.groupBy("u").transformWithStateInPandas(
        statefulProcessor=ItemHistory(["seq"], "item", ["seq"], ttl_ms=3000),
        outputStructType="seq long, item string, item_a string, item_b string, inc long",
        outputMode="Append", timeMode="ProcessingTime")
    q = (out.writeStream.format("memory").queryName("kf_ttl").option("checkpointLocation", f"{base}/ck")
         .trigger(processingTime="500 milliseconds").start())
    try:
        spark.createDataFrame([(1, "u", "A"), (2, "u", "B")], schema).write.mode("append").parquet(f"{base}/in")
        wait_rows(q, 2)
        time.sleep(8)                      # longer than the TTL: A and B expire
        spark.createDataFrame([(3, "u", "C")], schema).write.mode("append").parquet(f"{base}/in")
        wait_rows(q, 3)
    finally:
        q.stop()
    got = sorted((r.seq, r.item_a, r.item_b) for r in spark.sql("SELECT * FROM kf_ttl").collect())
    assert got == [(2, "A", "B")]
