"""One row per key, chosen by an order.

Both forms rank and keep rank 1. Spark applies that limit before the exchange as well, so
a task sends one row per key and a key that holds a third of the rows arrives small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], count: int = 1) -> DataFrame:
    """The first ``count`` rows of each key; ``order`` may hold ``name DESC``."""
    ranked = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return rows.selectExpr("*", f"{ranked} AS _rank").where(f"_rank <= {int(count)}").drop("_rank")


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return first_rows(rows, keys, order)


def last_wins(
    rows: DataFrame, keys: Sequence[str], version: str, order: Sequence[str] = ()
) -> DataFrame:
    """The row of each key with the highest version; among equals the last in ``order``."""
    return first_rows(rows, keys, [f"{name} DESC" for name in (version, *order)])
