"""Markdown summary of every batch query's physical plan (exchanges, joins, Python, scans).

    python tools/plan_report.py [sf_dir]   > plan table on stdout
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyflow.plans.queries import BATCH_QUERIES  # noqa: E402
from keyflow.session import build_session  # noqa: E402


def summarize(plan: str) -> dict[str, str]:
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|RoundRobinPartitioning\(\d+|SinglePartition)", plan)
    joins = sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)))
    python = sorted(set(re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {"shuffles": ", ".join(e.split("(")[0] + ("(" + e.split("(")[1].split("#")[0] + ")" if "(" in e else "")
                                  for e in exchanges) or "none",
            "joins": ", ".join(joins) or "none", "python": ", ".join(python) or "none",
            "columns read": "; ".join(s.replace(":bigint", "").replace(":string", "")
                                      .replace(":timestamp_ntz", "").replace(":double", "")
                                      .replace(":int", "") for s in scans)}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("| query | shuffles (initial plan) | joins | Python | columns read |")
    print("|---|---|---|---|---|")
    for name, fn in BATCH_QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['joins']} | {s['python']} | {s['columns read']} |")
    spark.stop()


if __name__ == "__main__":
    main()
