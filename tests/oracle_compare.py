"""Run every registered Spark query and its DuckDB oracle side by side.

Usage:  python tests/oracle_compare.py [sf_dir] [key ...]

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), printing one line per key.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()[:16]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as ep

    qs = ep.queries()
    sql = ep.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        sdf = qs[key](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        t1 = time.time()
        rec = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if key in sql:
            cur = con.execute(sql[key])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            rec.update(
                oracle_rows=len(d_rows),
                columns_match=sorted(s_cols) == sorted(d_cols),
                values_match=digest(s_cols, s_rows) == digest(d_cols, d_rows),
            )
            rec["match"] = rec["columns_match"] and rec["values_match"] and len(s_rows) == len(d_rows)
            if not rec["columns_match"]:
                rec["cols"] = (s_cols, d_cols)
        else:
            rec["match"] = None
        results[key] = rec
        if verbose:
            print(key, rec, flush=True)
    return results


if __name__ == "__main__":
    from ledgerstar.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, keys)
    bad = [k for k, r in res.items() if r["match"] is False]
    print("MISMATCH:", bad)
    print("OK:", sum(1 for r in res.values() if r["match"]), "of", len(res))
