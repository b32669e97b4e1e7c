"""Command line: list, run or explain a registered query.

    python -m keyflow list
    python -m keyflow run <query> [sf_dir] [--rows N]
    python -m keyflow explain <query> [sf_dir]
"""

from __future__ import annotations

import argparse
import time

from keyflow.plans import all_queries


def main() -> None:
    parser = argparse.ArgumentParser(prog="keyflow")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered queries")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
        p.add_argument("--rows", type=int, default=20)
    args = parser.parse_args()
    queries = all_queries()
    if args.cmd == "list":
        for name, fn in queries.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:30s} {doc[0] if doc else ''}")
        return

    from keyflow.session import build_session
    spark = build_session()
    df = queries[args.query](spark, args.sf_dir)
    if args.cmd == "explain":
        df.explain("formatted")
    else:
        start = time.perf_counter()
        rows = df.count()
        df.show(args.rows, truncate=80)
        print(f"{rows} rows in {time.perf_counter() - start:.2f} s")
    spark.stop()


if __name__ == "__main__":
    main()
