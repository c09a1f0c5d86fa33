"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v)
    return "null" if v is None else str(v)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results are equal, else a short description."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = _sorted_rows(want_columns, result.fetchall())
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    off = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(off)} of {len(got)} rows differ, first {off[0]}" if off else None
