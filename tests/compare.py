"""Row-for-row comparison of a named query with its DuckDB statement."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}"))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:10]
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(frame, con, sql: str) -> list[str]:
    """Differences, none if the results match."""
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    expected = rows(columns, found.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(columns)}"]
    actual = rows(frame.columns, frame.collect())
    if actual == expected:
        return []
    a, b = set(actual), set(expected)
    return [f"rows {len(actual)} != {len(expected)}" if len(actual) != len(expected) else "values differ"] + [
        f"spark only {x}" for x in sorted(a - b)[:3]
    ] + [f"sql only {x}" for x in sorted(b - a)[:3]]
