"""Run every registered query against its SQL twin: python tests/oracle_check.py [sf] [names...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return repr(float(v)) if v != int(v) or abs(v) > 1e15 else str(int(v))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0]}", len(got)
    return None, len(got)


def main(sf, names):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"/root/testdata/sf{sf}"
    con, sqls, failed = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if (names and name not in names) or name not in sqls:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", 0
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s"
              + (f" {problem[:900]}" if problem else ""), flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "-v"]
    main(args[0] if args else "0.01", set(args[1:]))
