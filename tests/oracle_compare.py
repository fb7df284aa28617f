"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]

Comparison: same column names (sorted), same row count, same multiset of
rows after normalising values (floats rounded, timestamps as text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as ent

    qs, sqls = ent.queries(), ent.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in sqls:
                results[name] = ("rows-only", len(s_rows), None)
                continue
            cur = con.execute(sqls[name])
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
            ok_cols = sorted(s_cols) == sorted(d_cols)
            ok_n = len(s_rows) == len(d_rows)
            ok_v = ok_cols and ok_n and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
            results[name] = ("ok" if ok_v else "MISMATCH", len(s_rows), len(d_rows))
            if verbose:
                print(f"{name:24s} {'OK' if ok_v else 'MISMATCH'} spark={len(s_rows)} duck={len(d_rows)} "
                      f"cols={'=' if ok_cols else (sorted(s_cols), sorted(d_cols))} {t1 - t0:.1f}s", flush=True)
            if not ok_v and ok_cols and verbose:
                a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                sa, sb = set(a), set(b)
                print("   spark-only:", list(sa - sb)[:3])
                print("   duck-only: ", list(sb - sa)[:3])
        except Exception as e:  # report and continue
            results[name] = ("ERROR", repr(e)[:500], None)
            if verbose:
                print(f"{name:24s} ERROR {repr(e)[:800]}", flush=True)
    return results


if __name__ == "__main__":
    from chronodim.plans.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad if bad else "none")
