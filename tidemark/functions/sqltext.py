"""Pieces of SQL text for expressions over many columns.

A wide aggregate has thousands of sub-expressions. Building each through the Column
API costs a driver round trip per call; one text is parsed at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value, kind: str = "DOUBLE") -> str:
    """A literal of the given type; ``None`` is a typed NULL."""
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS {kind})"
    return f"CAST({value} AS {kind})"


def doubles(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(number(float(v)) for v in values)})")


def texts(values: Sequence[str]) -> Column:
    return F.expr(f"array({', '.join(text(v) for v in values)})")


def double_array(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles."""
    return F.expr(f"array({', '.join(f'CAST({name(c)} AS DOUBLE)' for c in columns)})")


def is_missing(column: str, dtype: T.DataType) -> str:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"({name(column)} IS NULL OR isnan({name(column)}))"
    return f"({name(column)} IS NULL)"


def rows_of(entries: Sequence[str]) -> Column:
    """One row per struct text."""
    return F.expr(f"explode(array({', '.join(entries)}))")
