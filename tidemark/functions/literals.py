"""Constant lists as SQL text: one expression, however long the list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def doubles(values: Iterable[float]) -> str:
    """An array of doubles, possibly empty."""
    return f"CAST(array({', '.join(f'{float(v)!r}D' for v in values)}) AS ARRAY<DOUBLE>)"


def texts(values: Iterable[object]) -> str:
    """An array of strings, possibly empty."""
    return f"CAST(array({', '.join(text(str(v)) for v in values)}) AS ARRAY<STRING>)"


def is_one_of(column: str, values: Iterable[object]) -> Column:
    """``column IN (values)``; false for an empty list."""
    listed = ", ".join(str(v) if isinstance(v, int) else text(str(v)) for v in values)
    return F.expr(f"`{column}` IN ({listed})") if listed else F.lit(False)


def cohorts_in(rows: DataFrame, column: str, cohorts: Iterable[object]) -> Column:
    """Rows of the cohorts, listed in the column's own type, so that the column itself is not cast."""
    if isinstance(rows.schema[column].dataType, T.StringType):
        return is_one_of(column, map(str, cohorts))
    return is_one_of(column, [c for c in cohorts if isinstance(c, int) or str(c).isdigit()])
