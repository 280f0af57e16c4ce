"""Compare registered queries with their DuckDB text. Usage: gate.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}/*.parquet'" if os.path.isdir(path) else f"create view {t} as select * from '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return True, f"rows={len(got)} (no oracle) {took:.1f}s"
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {set(columns) ^ set(df.columns)}"
    note = f"rows={len(got)} {took:.1f}s"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        note += f" want={len(want)} spark-only={sorted(a)[:2]} duck-only={sorted(b)[:2]}"
    return got == want, note


if __name__ == "__main__":
    from ledgerloom.session import build_session

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark = build_session(
        "gate",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), e.oracle_sql(), 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, e.queries()[name], oracles.get(name), sf_dir)
        except Exception as exc:  # report and go on to the next query
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    sys.exit(bool(bad))
