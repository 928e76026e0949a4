"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def key(row):
    return tuple((v is None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=key)


KINDS = {"bigint": "int", "int": "int", "double": "float", "string": "str", "boolean": "bool",
         "timestamp_ntz": "datetime", "INTEGER": "int", "BIGINT": "int", "DOUBLE": "float",
         "VARCHAR": "str", "BOOLEAN": "bool", "TIMESTAMP": "datetime"}


def compare(df, con, sql):
    """Empty text if equal, else what differs."""
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    names, want = rows_of([d[0] for d in described], cursor.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} instead of {names}"
    kinds = {n: KINDS.get(t, t) for n, t in df.dtypes}
    wanted = {n: KINDS.get(t, t) for n, t in described}
    if kinds != wanted:
        return f"types {kinds} instead of {wanted}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} instead of {b}"
    return ""
