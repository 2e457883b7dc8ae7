from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from quotelake import schemas as S
from quotelake.operators import dims, facts, quality
from quotelake.operators.keys import fact_id, number_after
from quotelake.sources.warehouse import no_rows

AT = dt.datetime(2024, 6, 1)
NOW = dt.datetime(2024, 7, 1)


@pytest.fixture
def quotes(spark):
    """Builds quotes from (ticker, date, close, source), in batch order."""

    def build(*rows):
        return spark.createDataFrame(
            [
                (ticker, dt.date.fromisoformat(day), *(Decimal(close),) * 4, Decimal(1), source, AT, n, 0)
                for n, (ticker, day, close, source) in enumerate(rows)
            ],
            S.QUOTES,
        )

    return build


@pytest.fixture
def load(spark):
    """Loads a batch on top of stored tables; returns assets, sources, dates, new facts."""

    def run(batch, assets=None, sources=None, dates=None, stored=None):
        assets = dims.upsert_assets(no_rows(spark, S.DIM_ASSETS) if assets is None else assets, dims.assets_in(batch), NOW)
        sources = dims.upsert_sources(no_rows(spark, S.DIM_SOURCES) if sources is None else sources, dims.sources_in(batch))
        dates = dims.missing_dates(no_rows(spark, S.DIM_DATES) if dates is None else dates, batch)
        stored = no_rows(spark, S.FACT_QUOTES) if stored is None else stored
        return assets, sources, dates, facts.facts_to_add(batch, assets, sources, stored, now=NOW)

    return run


def test_new_quote_is_added_and_a_stored_one_is_not(quotes, load):
    batch = quotes(("AAPL", "2024-01-15", "150", "YahooFinance"))
    assets, sources, dates, added = load(batch)
    rows = added.collect()
    assert [(r.date_key, r.close_price, r.loaded_at) for r in rows] == [(20240115, 150, NOW)]
    changed = quotes(("AAPL", "2024-01-15", "999", "YahooFinance"))
    again = load(changed, assets, sources, dates, added)
    assert again[3].count() == 0 and again[2].count() == 0


def test_asset_type_follows_the_source(quotes, load):
    assets = load(quotes(("A", "2024-01-15", "1", "YahooFinance"), ("B", "2024-01-15", "1", "CoinGecko")))[0]
    assert {r.ticker: r.asset_type for r in assets.collect()} == {"A": "Stock", "B": "Crypto"}


def test_asset_type_rule_can_be_extended(spark):
    row = spark.sql(
        f"SELECT {dims.asset_type_of('s', {'Funds': 'ETF'})} AS kind FROM VALUES ('Funds'), ('x'), ('CoinGecko') AS t(s)"
    ).collect()
    assert [r.kind for r in row] == ["ETF", "Stock", "Crypto"]


def test_first_quote_decides_the_type_of_an_asset(quotes, load):
    assets = load(quotes(("A", "2024-01-16", "1", "CoinGecko"), ("A", "2024-01-15", "1", "YahooFinance")))[0]
    assert assets.first().asset_type == "Crypto"


def test_one_asset_three_days(quotes, load):
    batch = quotes(*(("AAPL", f"2024-01-{day}", "1", "YahooFinance") for day in (15, 16, 17)))
    assert [part.count() for part in load(batch)] == [1, 1, 3, 3]


def test_no_quotes(quotes, load):
    assert [part.count() for part in load(quotes(("A", "2024-01-15", "1", "X")).where("false"))] == [0, 0, 0, 0]


def test_first_of_a_batch_wins(quotes, load):
    added = load(quotes(("BTC", "2024-03-07", "100", "CoinGecko"), ("BTC", "2024-03-07", "101", "CoinGecko")))[3]
    assert [r.close_price for r in added.collect()] == [100]


def test_loading_twice_adds_nothing(quotes, load):
    batch = quotes(("A", "2024-01-15", "1", "YahooFinance"), ("A", "2024-01-15", "1", "CoinGecko"))
    assets, sources, dates, added = load(batch)
    assert added.count() == 2
    assert load(batch, assets, sources, dates, added)[3].count() == 0


def test_replace_keeps_the_newest_load(spark, star):
    old, _, _ = star([(1, dt.date(2024, 1, 15), 1, 10), (2, dt.date(2024, 1, 15), 1, 20)])
    new, _, _ = star([(1, dt.date(2024, 1, 15), 1, 11)])
    later = new.selectExpr(*(c for c in new.columns if c != "loaded_at"), "loaded_at + INTERVAL 1 DAY AS loaded_at")
    closes = {r.asset_key: r.close_price for r in facts.replace_facts(old, later).collect()}
    assert closes == {1: 11, 2: 20}
    tie = {r.asset_key: r.close_price for r in facts.replace_facts(old, new).collect()}
    assert tie == {1: 11, 2: 20}


def test_upsert_keeps_key_and_creation(spark):
    stored = spark.createDataFrame(
        [(7, "T", "Original", "Stock", "NYSE", True, AT, AT), (3, "U", "Other", "ETF", None, False, AT, AT)], S.DIM_ASSETS
    )
    incoming = spark.createDataFrame(
        [("T", "Updated", "ETF", None, False), ("V", "New", "Stock", None, True)],
        "ticker string, name string, asset_type string, exchange string, is_active boolean",
    )
    rows = {r.ticker: r for r in dims.upsert_assets(stored, incoming, NOW).collect()}
    assert tuple(rows["T"]) == (7, "T", "Updated", "ETF", None, False, AT, NOW)
    assert tuple(rows["U"]) == (3, "U", "Other", "ETF", None, False, AT, AT)
    assert tuple(rows["V"]) == (8, "V", "New", "Stock", None, True, NOW, NOW)


def test_source_upsert(spark):
    stored = spark.createDataFrame([(1, "A", "old", True)], S.DIM_SOURCES)
    incoming = spark.createDataFrame([("A", "new", False), ("B", "", True)], "source_name string, base_url string, is_active boolean")
    assert sorted(tuple(r) for r in dims.upsert_sources(stored, incoming).collect()) == [
        (1, "A", "new", False), (2, "B", "", True),
    ]


def test_lookup_of_absent_keys(spark):
    stored = spark.createDataFrame([(1, "A", "", True)], S.DIM_SOURCES)
    wanted = spark.createDataFrame([("A",), ("Z",), ("A",)], "source_name string")
    found = {r.source_name: r.source_key for r in dims.lookup(stored, "source_name", wanted).collect()}
    assert found == {"A": 1, "Z": None}


def test_active_assets_are_sorted(star):
    _, assets, _ = star([(k, dt.date(2024, 1, 1), 1, 1) for k in (3, 1, 2)], inactive=(1,))
    assert [r.ticker for r in dims.active_assets(assets).collect()] == ["T2", "T3"]


def test_calendar(spark):
    days = [dt.date(2024, 3, 15), dt.date(2024, 3, 16), dt.date(2024, 3, 17), dt.date(2024, 12, 30)]
    wanted = spark.createDataFrame([(d,) for d in days * 2], "date date")
    rows = {r.full_date: r for r in dims.missing_dates(no_rows(spark, S.DIM_DATES), wanted).collect()}
    assert len(rows) == 4
    friday, saturday, sunday, monday = (rows[d] for d in days)
    assert (friday.date_key, friday.year, friday.quarter, friday.month, friday.day, friday.is_weekend) == (20240315, 2024, 1, 3, 15, False)
    assert (saturday.is_weekend, saturday.day_of_week) == (True, 6)
    assert (sunday.is_weekend, sunday.day_of_week) == (True, 0)
    assert (monday.week_of_year, monday.day_of_week, monday.quarter) == (1, 1, 4)
    stored = dims.missing_dates(no_rows(spark, S.DIM_DATES), wanted)
    assert dims.missing_dates(stored, wanted).count() == 0


def test_numbers_are_dense_and_repeatable(spark):
    rows = spark.range(20000).selectExpr("concat('T', id) AS ticker")
    stored = spark.createDataFrame([(41, "S")], "asset_key int, ticker string")
    numbered = number_after(rows, stored, "ticker", "asset_key")
    first = {r.ticker: r.asset_key for r in numbered.collect()}
    assert sorted(first.values()) == list(range(42, 20042))
    again = number_after(rows.repartition(7), stored, "ticker", "asset_key")
    assert {r.ticker: r.asset_key for r in again.collect()} == first


def test_fact_ids_are_different_and_sorted(spark):
    highest = 2**31 - 1
    keys = [(a, d, s) for a in (0, 1, 5, highest) for d in (10101, 20240229, 99991231) for s in (1, 2, 1023)]
    rows = spark.createDataFrame(keys, "a int, d int, s int").selectExpr("a", "d", "s", f"{fact_id('a', 'd', 's')} AS id").collect()
    by_key = [r.id for r in sorted(rows, key=lambda r: (r.a, r.d, r.s))]
    assert by_key == sorted(set(by_key)) and by_key[0] >= 0


def test_pages_cover_the_fact(star):
    quotes, _, _ = star([(1, dt.date(2024, 1, day), 1, day) for day in range(1, 11)])
    last, seen = 0, []
    while page := facts.fact_page(quotes, last, 4).collect():
        seen += [r.id for r in page]
        last = page[-1].id
    assert seen == sorted(r.id for r in quotes.collect())


def test_constraints(star, spark):
    quotes, assets, _ = star([(1, dt.date(2024, 1, 1), 1, 5), (1, dt.date(2024, 1, 1), 1, 6), (2, dt.date(2024, 1, 1), 1, 7)])
    repeated = quality.duplicate_keys(quotes, S.FACT_KEY).collect()
    assert [tuple(r) for r in repeated] == [(1, 20240101, 1, 2)]
    assert [r.asset_key for r in quality.orphans(quotes, assets.where("asset_key = 1"), "asset_key").collect()] == [2]
    long_name = assets.selectExpr("asset_key", "ticker", "repeat('x', 201) AS name", "CAST(NULL AS STRING) AS asset_type",
                                  "exchange", "is_active", "created_at", "updated_at")
    found = {(r.column_name, r.rule): r.n_rows for r in quality.domain_violations(long_name, "dim_assets").collect()}
    assert {k: n for k, n in found.items() if n} == {("name", "length"): 2, ("asset_type", "required"): 2}
