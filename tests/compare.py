"""Side-by-side comparison of a registered query with its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, type(v).__name__, v) for v in r),
    )


def difference(df, con, sql: str) -> str | None:
    """None when columns, types' kinds and all rows agree, else what differs."""
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    ours, theirs = _normal(df.columns, df.collect()), _normal(sql_columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            return f"{sorted(df.columns)}\n ours   {a}\n theirs {b}"
    return None
