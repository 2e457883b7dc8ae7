from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quotelake import schemas as S  # noqa: E402
from quotelake.session import build_session  # noqa: E402

AT = dt.datetime(2024, 6, 1, 12, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "quotelake-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    """Builds lake records from (source, content) pairs."""

    def build(*records, first_id=1, at=AT):
        rows = [
            (number, source, source, content, at + dt.timedelta(minutes=number), False)
            for number, (source, content) in enumerate(records, start=first_id)
        ]
        return spark.createDataFrame(rows, S.LAKE)

    return build


@pytest.fixture
def star(spark):
    """Builds facts, assets and dates from (asset, date, source, close) rows; an asset
    named in ``inactive`` is not active."""
    from quotelake.operators.dims import missing_dates
    from quotelake.sources.warehouse import no_rows

    def build(rows, inactive=()):
        facts = spark.createDataFrame(
            [
                (number, asset, day.year * 10000 + day.month * 100 + day.day, source,
                 *(Decimal(str(close)),) * 4, Decimal(number), AT)
                for number, (asset, day, source, close) in enumerate(rows, start=1)
            ],
            S.FACT_QUOTES,
        )
        names = sorted({row[0] for row in rows})
        assets = spark.createDataFrame(
            [(key, f"T{key}", f"Name {key}", "Stock", None, key not in inactive, AT, AT) for key in names],
            S.DIM_ASSETS,
        )
        days = spark.createDataFrame([(day,) for day in {row[1] for row in rows}], "date date")
        return facts, assets, missing_dates(no_rows(spark, S.DIM_DATES), days)

    return build
