"""Compares registered queries with their SQL, as multisets of rows. Also a script: ``python tests/compare.py sf_dir [name...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "as_tuple"):
        return canon(float(v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in data), key=repr)


def connect(base):
    con = duckdb.connect()
    for p in glob.glob(f"{base}/*.parquet"):
        at = p if os.path.isfile(p) else f"{p}/*.parquet"
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{at}'")
    return con


def check(spark, base, name, f, sql, con):
    t = time.time()
    df = f(spark, base)
    got = df.collect()
    took = time.time() - t
    if sql is None:
        return None, len(got), took, ""
    t = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    sql_took = time.time() - t
    if sorted(names) != sorted(df.columns):
        return False, len(got), took, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows(df.columns, [tuple(r) for r in got]), rows(names, want)
    why = "" if a == b else f"{len(a)} vs {len(b)} rows; first differing: {next(((x, y) for x, y in zip(a, b) if x != y), None)}"
    return a == b, len(got), took, why or f"sql {sql_took:.1f}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    base, names = sys.argv[1], sys.argv[2:]
    con = connect(base)
    bad = 0
    for n, f in e.queries().items():
        if names and not any(n.startswith(x) for x in names):
            continue
        try:
            ok, count, took, why = check(spark, base, n, f, e.oracle_sql().get(n), con)
        except Exception as x:
            ok, count, took, why = False, 0, 0, repr(x)[:1500]
        bad += ok is False
        print(f"{'ok' if ok else 'ROWS' if ok is None else 'FAIL'} {n} rows={count} {took:.1f}s {why[:1500]}", flush=True)
    print("failed:", bad)
