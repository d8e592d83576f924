"""Compare registered queries with their SQL twins in DuckDB: python check.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tallgrass import build_session
from tallgrass.catalog import QUERIES, TWINS

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v: object) -> object:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        # 9 significant digits; whole numbers and floats compare alike
        return f"{float(v):.9g}" if abs(float(v)) > 1e-9 else "0"
    return str(v)


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(_value(r[i])) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    df = QUERIES[name](spark, folder)
    got_cols, got = rows_of(df.columns, df.collect())
    if name not in TWINS:
        return f"rows-only {len(got)}"
    cur = con.execute(TWINS[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"FAIL columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"FAIL rows {len(got)} != {len(want)}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"FAIL values: {len(bad)} of {len(got)} differ, first {bad[0]}"
    return f"ok {len(got)}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in names:
        begin = time.time()
        try:
            outcome = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        failed += outcome.startswith(("FAIL", "ERROR"))
        print(f"{name:28s} {time.time() - begin:6.2f}s  {outcome}", flush=True)
    print("failed:", failed)
