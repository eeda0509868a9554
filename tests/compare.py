"""Compare registered queries with their SQL on another engine."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def difference(result, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs_types = [str(c[1]) for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    spark_types = dict(result.dtypes)
    wrong = [(n, spark_types[n], t) for n, t in zip(names, theirs_types) if kinds.get(t) != spark_types[n]]
    if wrong:
        return f"types {wrong}"
    mine = _rows(result.columns, [tuple(r) for r in result.collect()])
    theirs = _rows(names, expected)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
