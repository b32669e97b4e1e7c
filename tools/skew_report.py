"""Measure the largest window task with and without chunking, from Spark's event log.

One user is given a third of all events (derived from the events table).  The
running count then runs twice: once as a plain per-key window (chunking off)
and once chunked.  Task metrics come from the event log in a fresh scratch
folder; the report lists, per run, the largest number of shuffle records a
single task read.

    python tools/skew_report.py [sf_dir] [rows_per_chunk] [shuffle_partitions]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from keyflow.operators.running import running_count  # noqa: E402
from keyflow.operators.scan import next_in_key  # noqa: E402
from keyflow.session import RECOMMENDED_CONF, ensure_checkpoint_dir  # noqa: E402
from keyflow.sources.tables import load  # noqa: E402


def task_reads(log_dir: str) -> dict[int, dict[int, list[int]]]:
    """job id -> stage id -> shuffle records read per task."""
    stage_job: dict[int, int] = {}
    out: dict[int, dict[int, list[int]]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    sid = ev["Stage ID"]
                    out.setdefault(stage_job.get(sid, -1), {}).setdefault(sid, []).append(read)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rows_per_chunk = int(sys.argv[2]) if len(sys.argv) > 2 else 5_000
    partitions = sys.argv[3] if len(sys.argv) > 3 else "16"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    builder = (SparkSession.builder.master("local[8]").appName("skew-report")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", partitions)
               .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
               .config("spark.eventLog.compress", "false"))
    for key, value in RECOMMENDED_CONF.items():
        if key != "spark.sql.adaptive.coalescePartitions.enabled":
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ev = load(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
        .alias("user_id"))
    total = ev.count()
    results = {}
    scans = {
        "running count": lambda rpc: running_count(ev, ["user_id"], ["ts", "event_id"], rows_per_chunk=rpc),
        "next row (lead)": lambda rpc: next_in_key(ev, ["user_id"], ["ts", "event_id"], ["event_id"],
                                                   rows_per_chunk=rpc),
    }
    for scan, build in scans.items():
        for label, rpc in (("plain window", 10 ** 12), ("chunked", rows_per_chunk)):
            before = {j for j in task_reads(log_dir)}
            build(rpc).write.format("noop").mode("overwrite").save()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
            reads = task_reads(log_dir)
            new_jobs = {j: s for j, s in reads.items() if j not in before}
            biggest = max((max(v) for s in new_jobs.values() for v in s.values() if v), default=0)
            results[f"{scan}: {label}"] = biggest
    spark.stop()
    print(json.dumps({"shuffle_partitions": int(partitions), "rows": total, "hot_key_rows": total // 3 + 1, "rows_per_chunk": rows_per_chunk,
                      "max_shuffle_records_per_task": results, "event_log": log_dir}))


if __name__ == "__main__":
    main()
