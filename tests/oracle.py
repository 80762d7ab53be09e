"""Run one registered query and its SQL twin on the same tables and compare."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, repr(value + 0.0))
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark, con, query, sql, folder):
    """(equal, message, seconds in Spark)"""
    start = time.time()
    df = query(spark, folder)
    ours, our_columns = _rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs, their_columns = _rows(columns, result.fetchall())
    if our_columns != their_columns:
        return False, f"columns {our_columns} != {their_columns}", took
    kinds = {str(n): str(t) for n, t in zip(columns, [d[1] for d in con.execute(sql).description])}
    for name, kind in df.dtypes:
        if kind in ("bigint", "double", "string", "int", "boolean"):
            want = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
            if kinds[name] != want[kind]:
                return False, f"type of {name}: {kind} != {kinds[name]}", took
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        return False, f"rows {len(ours)} / {len(theirs)}; only ours {extra}; only theirs {missing}", took
    return True, f"{len(ours)} rows", took
