"""Runs registered queries beside their DuckDB oracles and compares the rows."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, build, sql: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    result = build(spark, folder)
    mine = rows_of(result.columns, [tuple(row) for row in result.collect()])
    connection = connect(folder)
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows; first {mine[:1]} / {theirs[:1]}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {sorted(names)}\n  {bad[0][0]}\n  {bad[0][1]}"
    return None if mine else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tickloom.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN"):
        # A session without this package's settings, as a caller might bring it.
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    picked = sys.argv[1:]
    oracles = oracle_sql()
    for name, build in queries().items():
        if picked and not any(name.startswith(p) for p in picked):
            continue
        began = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, build, oracles[name], folder) or "ok"
            else:
                verdict = f"rows only: {build(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        print(f"{name:32s} {time.time() - began:6.1f}s  {verdict}", flush=True)
