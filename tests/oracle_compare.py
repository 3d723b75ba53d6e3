"""Run Spark queries and their DuckDB oracle side by side and compare.

Comparison: column names (sorted), row count, and the multiset of rows with
each value rendered as text (so decimals must also agree in scale).

    python -m tests.oracle_compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    import os

    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    return str(v)


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(t[i]) for i in order) for t in tuples)


def compare(spark, sf_dir: str, keys=None) -> dict:
    import __spark_entry__ as e

    qs = e.queries()
    oracle = e.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for k in keys or list(qs):
        t0 = time.time()
        df = qs[k](spark, sf_dir)
        s_names = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if k not in oracle:
            report[k] = {"rows": len(s_rows), "oracle": None}
            continue
        rel = con.sql(oracle[k])
        o_names = rel.columns
        o_rows = rel.fetchall()
        ok_names = sorted(s_names) == sorted(o_names)
        same = ok_names and rows_of(s_names, s_rows) == rows_of(o_names, o_rows)
        entry = {
            "spark_rows": len(s_rows),
            "oracle_rows": len(o_rows),
            "names": ok_names,
            "match": same,
            "spark_sec": round(t1 - t0, 2),
        }
        if not same:
            entry["spark_cols"] = s_names
            entry["oracle_cols"] = o_names
            if ok_names:
                a = rows_of(s_names, s_rows)
                b = rows_of(o_names, o_rows)
                entry["only_spark"] = list((a - b).elements())[:3]
                entry["only_oracle"] = list((b - a).elements())[:3]
        report[k] = entry
    return report


if __name__ == "__main__":
    from remitlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session()
    rep = compare(spark, sf, keys)
    bad = 0
    for k, v in rep.items():
        print(k, v)
        bad += 0 if v.get("match", True) else 1
    print("mismatches:", bad, "of", len(rep))
