"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def named_struct(**fields: str) -> str:
    """A struct of named SQL expressions."""
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in fields.items())})"


def once(rows: DataFrame, **columns: str) -> DataFrame:
    """Adds costly columns, given as SQL, as the single element of a generated array.

    The optimizer copies a projected expression into every filter pushed below it, which
    for JSON means parsing again. A generated column is only ever read.
    """
    return rows.selectExpr("*", f"inline(array({named_struct(**columns)}))")
