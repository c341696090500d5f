"""Run queries beside their DuckDB texts: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

from checks.fixtures import TABLES
from checks.registry import ORACLE, QUERIES
from mediasignal.session import build_session


def norm(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, str, int, float]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    took = time.time() - start
    if name not in ORACLE:
        return "ROWS", "", len(got), took
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    want = rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return "COLS", f"{sorted(df.columns)} != {sorted(columns)}", len(got), took
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2]
        only_want = [r for r in want if r not in set(got)][:2]
        return "DIFF", f"{len(got)}/{len(want)} rows\n  spark {only_got}\n  duck  {only_want}", len(got), took
    return "OK", "", len(got), took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            state, note, n, took = compare(spark, con, sf_dir, name)
        except Exception as exc:
            state, note, n, took = "FAIL", f"{type(exc).__name__}: {str(exc)[:700]}", 0, 0.0
        bad += state not in ("OK", "ROWS")
        print(f"{state:5} {name:24} {n:8} rows {took:6.1f}s {note}", flush=True)
    print("failures:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
