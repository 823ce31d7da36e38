"""Comparison of a query with its DuckDB counterpart, as sorted rows with columns by name."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ("", "null")
    return (type(x).__name__, repr(x))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(cell(r[i]) for i in order) for r in rows])


def differences(df, con, sql: str) -> str | None:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    want = rows_of([c[0] for c in found.description], found.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} and {len(want[1])} rows"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{a} and {b}"
    return None
