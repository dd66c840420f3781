"""Run queries next to their SQL in DuckDB and compare names, types and values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        v = v.item()
    return v


def rows(columns, data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in data), key=lambda r: tuple(map(repr, r))
    )


SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, query, sql: str, folder: str) -> list[str]:
    """What differs; empty if nothing does."""
    got = query(spark, folder)
    want = con.sql(sql)
    found = []
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    wanted_types = dict(zip(want.columns, map(str, want.types)))
    for name, kind in got.dtypes:
        if SAME_TYPE.get(kind) != wanted_types[name]:
            found.append(f"{name}: {kind} != {wanted_types[name]}")
    a = rows(got.columns, [tuple(r) for r in got.collect()])
    b = rows(want.columns, want.fetchall())
    if len(a) != len(b):
        found.append(f"{len(a)} rows != {len(b)}")
    elif a != b:
        bad = next((x, y) for x, y in zip(a, b) if x != y)
        found.append(f"{sum(x != y for x, y in zip(a, b))} of {len(a)} rows differ, first {bad}")
    return found
