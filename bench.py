"""Benchmark: run the registered queries at $BENCH_SF_DIR and print one JSON line.

Each query is fully computed with a ``noop`` write (no driver collect); the
time per query is wall-clock seconds including planning and any helper jobs
(counts / quantiles of the skew-safe scans).  After a warm-up pass at sf0.001
every query runs ``BENCH_REPEAT`` times (default 2) and the fastest run is
reported.  Set ``BENCH_STREAMS=1`` to add the streaming twins,
``BENCH_QUERIES=a,b`` to run a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keyflow.plans.queries import BATCH_QUERIES  # noqa: E402
from keyflow.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    queries = dict(BATCH_QUERIES)
    if os.environ.get("BENCH_STREAMS") == "1":
        from keyflow.plans.streams import STREAM_QUERIES
        queries.update(STREAM_QUERIES)
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    if only:
        queries = {k: v for k, v in queries.items() if k in only}

    # Warm-up (JVM, codegen caches, Python workers); not timed.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for fn in BATCH_QUERIES.values():
            try:
                fn(spark, warm).write.format("noop").mode("overwrite").save()
            except Exception:  # warm-up only
                pass

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, fn in queries.items():
        runs = []
        try:
            for _ in range(repeat):
                start = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
            times[name] = round(min(runs), 3)
        except Exception as exc:  # keep the JSON line even if one query fails
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_query_seconds",
            "value": round(sum(t for t in times.values() if t is not None), 3),
            "unit": "sec", "queries": times, "sf": sf,
            "method": f"best of {repeat} after warm-up, local[{cpus}]"}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
