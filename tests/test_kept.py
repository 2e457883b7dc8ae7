"""Kept mart state against the full marts, load by load."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row

from quotelake import schemas as S
from quotelake.plans import kept, marts
from quotelake.session import shared_dir
from quotelake.sources.warehouse import Warehouse, compact, write_facts

AT = dt.datetime(2024, 6, 1)


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture
def house(spark):
    return Warehouse.create(spark, shared_dir(spark, "kept"))


def load(spark, house, rows):
    """Stores (asset, date, source, close) rows as the next load."""
    number = house.last["load"] + 1
    facts = spark.createDataFrame(
        [(n, a, key(d), s, *(Decimal(c),) * 4, Decimal(1), AT) for n, (a, d, s, c) in enumerate(rows)], S.FACT_QUOTES
    )
    write_facts(house, number, facts)
    house.commit(Row(load=number, dims_load=0))


def both(facts, assets, day):
    summary = marts.portfolio_summary(facts, assets)
    screener = marts.week52_high_low(facts, assets, day)
    return sorted(map(tuple, summary.collect())), sorted(map(tuple, screener.collect()))


def test_every_load_equals_the_full_marts(spark, house, star):
    """Old days come late, closes repeat, assets pause for more than a year."""
    rng, begin = random.Random(4), dt.date(2021, 1, 1)
    _, assets, _ = star([(a, begin, 1, 1) for a in range(1, 9)], inactive=(8,))
    state, seen = kept.MartState(house, buckets=4), set()
    for step in range(4):
        rows, today = {}, begin + dt.timedelta(days=200 * (step + 1))
        for _ in range(120):
            back = rng.choice((rng.randrange(200), rng.randrange(200), rng.randrange(200 * (step + 1))))
            asset = rng.randrange(1, 9)
            if asset == 7 and 0 < step < 3:
                continue
            place = (asset, today - dt.timedelta(days=back), rng.randrange(1, 4))
            if place not in seen:
                rows[place] = rng.randrange(1, 30)
        seen |= set(rows)
        load(spark, house, [(*place, close) for place, close in rows.items()])
        state.refresh(today)
        for ahead in (0, 40)[step % 2 :]:
            day = today + dt.timedelta(days=ahead)
            assert both(state.facts(day), assets, day) == both(house.facts(), assets, day)
    held = state.facts(today).select("asset_key", "date_key").distinct().count()
    assert held < len({place[:2] for place in seen}) / 2


def test_a_refresh_reads_and_writes_what_the_load_touched(spark, house):
    day = dt.date(2024, 1, 10)
    state = kept.MartState(house, buckets=16)
    load(spark, house, [(a, day, 1, a) for a in range(1, 60)])
    first = state.refresh(day)
    load(spark, house, [(5, day + dt.timedelta(days=1), 1, 7)])
    read = kept.unknown(house, first).inputFiles()
    assert read and all("/attempt=0000000002-" in file for file in read)
    second = state.refresh(day)
    changed = {b for b in second["buckets"] if second["buckets"][b] != first["buckets"].get(b)}
    assert len(changed) == 1 and len(second["buckets"]) == len(first["buckets"])
    assert state.refresh(day) == second
    compact(house)
    assert kept.unknown(house, second).count() == 0 and state.refresh(day)["buckets"] == second["buckets"]


def test_a_refresh_that_another_one_overtook_starts_again_on_top_of_it(spark, house, star):
    day = dt.date(2024, 1, 10)
    _, assets, _ = star([(1, day, 1, 1)])
    state, other = kept.MartState(house), kept.MartState(house)
    load(spark, house, [(1, day, 1, 5)])
    known = state.manifest
    state.manifest = lambda: (other.refresh(day), setattr(state, "manifest", known), None)[2]
    held = state.refresh(day)
    assert held["version"] == 0 and held == other.manifest()
    assert both(state.facts(day), assets, day) == both(house.facts(), assets, day)


def test_days_the_state_cannot_answer_are_errors(spark, house):
    state = kept.MartState(house)
    with pytest.raises(ValueError, match="no mart state"):
        state.facts(dt.date(2024, 1, 1))
    load(spark, house, [(1, dt.date(2024, 1, 1), 1, 5)])
    state.refresh(dt.date(2024, 6, 1))
    with pytest.raises(ValueError, match="earlier"):
        state.facts(dt.date(2024, 5, 31))


def test_one_asset_with_most_rows_is_combined_before_the_exchange(spark):
    facts = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 1, int(id)) AS asset_key", "20240101 + int(id % 28) AS date_key", "int(id % 1000) AS source_key",
        "CAST(id % 97 AS DECIMAL(18,8)) AS close_price",
    )
    plan = kept.days_of(facts)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_min" in plan
