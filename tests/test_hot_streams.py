"""Running totals on streams whose keys are few and hot: what reaches the keyed state stays small."""

import random
from collections import Counter

from pyspark.sql import types as T

from keyflow.session import shared_path
from keyflow.sources import stream_table
from keyflow.streaming.running import carried_totals, read_running, running_batches


def test_a_hot_key_reaches_its_counter_as_one_row_a_batch(spark):
    base = shared_path(spark, "tests", "running", fresh=True)
    schema = T.StructType.fromDDL("seq long, k string, w long")
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 8 + ["x", None]), rng.randint(1, 9)) for i in range(300)]
    for a, b in ((0, 120), (120, 130), (130, 300)):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = stream_table(spark, f"{base}/in", schema=schema)
        for query in (lambda: running_batches(stream, ["k"], ["seq"], f"{base}/out", f"{base}/ck", weight="w", rows_per_chunk=40),
                      lambda: carried_totals(spark, [schema["k"]], f"{base}/out", f"{base}/ck-carried")):
            started = query()
            started.awaitTermination()
            assert started.exception() is None
    seen, want = Counter(), []
    for seq, k, w in rows:
        seen[k] += w
        want.append((seq, k, w, seen[k]))
    assert sorted(map(tuple, read_running(spark, ["k"], f"{base}/out").collect())) == want
    carried = [(r.k, r.batch_id) for r in spark.read.parquet(f"{base}/out/carried").collect()]
    assert len(carried) == len(set(carried)) <= 3 * 3      # the keyed state took no more rows than keys and batches
