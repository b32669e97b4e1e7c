"""Command-line contracts: bench.py prints one JSON line; python -m keyflow lists the queries."""

import json
import os
import subprocess
import sys

from support import ROOT


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="upper_map,double_even",
               BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    line = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(line)
    assert line["unit"] == "sec" and set(line["queries"]) == {"upper_map", "double_even"}
    assert all(isinstance(v, float) for v in line["queries"].values())


def test_module_lists_every_query():
    out = subprocess.run([sys.executable, "-m", "keyflow", "list"], cwd=ROOT,
                         capture_output=True, text=True, timeout=300)
    names = {ln.split()[0] for ln in out.stdout.splitlines() if ln.strip()}
    from keyflow.plans import all_queries
    assert names == set(all_queries())
