"""Every query against its SQL on the small tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from quotelake import oracles, queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def sortable(rows):
    def cell(value):
        if isinstance(value, bool) or value is None or isinstance(value, str):
            return repr(value)
        number = float(value)
        return "None" if math.isnan(number) else repr(number)

    return sorted([cell(value) for value in row] for row in rows)


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    found = queries.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = duck.sql(oracles.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    rows = found.select(*columns).collect()
    assert rows
    assert sortable(rows) == sortable(expected.select(*(f'"{c}"' for c in columns)).fetchall())
