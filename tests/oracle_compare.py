"""Run a registered query in Spark and its oracle in DuckDB; compare rows.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in records:
        out.append(tuple(_norm(r[i]) for i in order))
    return sorted(out, key=repr), [cols[i] for i in order]


def compare(spark, con, key: str, sf_dir: str, verbose: bool = True) -> bool:
    from quarry.plans.oracle_sql import ORACLE
    from quarry.plans.registry import QUERIES
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_sorted, s_cols = rows_of(sdf.columns, s_rows)
    if key not in ORACLE:
        print(f"{key}: spark {len(s_rows)} rows ({t1 - t0:.1f}s), no oracle")
        return True
    res = con.execute(ORACLE[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    d_sorted, d_cols = rows_of(d_cols, d_rows)
    ok = s_cols == d_cols and s_sorted == d_sorted
    print(f"{key}: {'OK ' if ok else 'DIFF'} spark={len(s_rows)} ({t1 - t0:.1f}s) "
          f"duck={len(d_rows)} ({t2 - t1:.1f}s)")
    if not ok and verbose:
        if s_cols != d_cols:
            print("  cols", s_cols, d_cols)
        ss, ds = set(s_sorted), set(d_sorted)
        print("  only spark:", sorted(ss - ds, key=repr)[:5])
        print("  only duck :", sorted(ds - ss, key=repr)[:5])
    return ok


def main():
    from quarry.plans.registry import QUERIES
    from quarry.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = [k for k in keys if not compare(spark, con, k, sf_dir)]
    print("FAILED:", bad if bad else "none")


if __name__ == "__main__":
    main()
