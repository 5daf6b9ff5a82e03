"""Spark-vs-DuckDB comparison used by the oracle tests: same column names,
same row count, same multiset of rows (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", repr(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, decimal.Decimal):
        return ("num", repr(float(v)))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("str", str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    a, _ = rows_of(s_cols, s_rows)
    b, names = rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({names}): {diff}"
    return True, f"{len(s_rows)} rows"


# Spark type -> DuckDB type name, for the schema half of the gate.
SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def type_diff(spark_df, con, sql: str) -> dict:
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
