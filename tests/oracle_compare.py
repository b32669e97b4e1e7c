"""Run a registered Spark query and its DuckDB oracle; compare as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

from keyflow.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, float)):
        return float(v)
    return v


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = sorted((tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()), key=repr)
    rel = con.execute(sql)
    d_cols_raw = [d[0] for d in rel.description]
    d_data = rel.fetchall()
    d_cols = sorted(d_cols_raw)
    pos = [d_cols_raw.index(c) for c in d_cols]
    d_rows = sorted((tuple(_norm(row[i]) for i in pos) for row in d_data), key=repr)
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"{name}: first diff spark={a} duck={b}"
    return True, f"{name}: ok ({len(s_rows)} rows)"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from keyflow.plans import ORACLES, all_queries
    from keyflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    import os
    if os.environ.get("KEYFLOW_ROWS_PER_CHUNK"):
        from keyflow.operators.scan import ROWS_PER_CHUNK_CONF
        spark.conf.set(ROWS_PER_CHUNK_CONF, os.environ["KEYFLOW_ROWS_PER_CHUNK"])
    con = duck(sf)
    bad = 0
    for name, fn in all_queries().items():
        if only and name not in only:
            continue
        if name not in ORACLES:
            print(f"{name}: no oracle")
            continue
        try:
            ok, msg = compare(spark, name, fn, ORACLES[name], sf, con)
        except Exception as exc:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(msg, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
