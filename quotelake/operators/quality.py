"""Constraints that a file-based warehouse has to check by query."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphans(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension does not have."""
    return rows.join(dim.select(key), key, "left_anti")


def constraint_counts(
    unique: dict[str, tuple[DataFrame, Sequence[str]]],
    references: dict[str, tuple[DataFrame, DataFrame, str]],
) -> DataFrame:
    """How many keys break each unique rule and how many rows each reference rule."""
    found = [("unique", name, duplicate_keys(rows, keys)) for name, (rows, keys) in unique.items()]
    found += [("reference", name, orphans(rows, dim, key)) for name, (rows, dim, key) in references.items()]
    counts = (
        broken.agg(F.count("*").alias("n_broken")).selectExpr(f"'{rule}' AS rule", f"'{name}' AS subject", "n_broken")
        for rule, name, broken in found
    )
    return reduce(DataFrame.unionByName, counts)


def domain_violations(
    rows: DataFrame, table: str, allowed: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows breaking each rule of ``table``, counted in one pass over it.

    Rules are the required columns, the longest texts, and any allowed values given.
    """
    rules = [(name, "required", f"{name} IS NULL") for name in S.REQUIRED.get(table, ())]
    for name, limit in S.MAX_LENGTH.get(table, {}).items():
        rules.append((name, "length", f"length({name}) > {limit}"))
    for name, values in (allowed or {}).items():
        listed = ", ".join(f"'{value.lower()}'" for value in values)
        rules.append((name, "allowed", f"lower({name}) NOT IN ({listed})"))
    checks = ", ".join(
        f"named_struct('table_name', '{table}', 'column_name', '{name}', 'rule', '{rule}', "
        f"'n_rows', count_if({broken}))"
        for name, rule, broken in rules
    )
    return rows.agg(F.expr(f"array({checks})").alias("checks")).selectExpr("inline(checks)")
