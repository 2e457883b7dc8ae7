"""The operators' queries against their SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from quotelake.llm import oracles, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", ["op12_tree_merge_dedup", "op13_target_resampling"])
def test_query(spark, duck, name):
    found = queries.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = duck.sql(oracles.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    expected = expected.select(*(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, expected))
