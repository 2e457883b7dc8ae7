"""Rolling means of long histories, pages, the cube, sketches and rebased loads."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.operators import facts as fact_ops
from quotelake.operators.series import rolling_means
from quotelake.plans import cube, etl, sketches
from quotelake.session import shared_dir
from quotelake.sources.warehouse import CommitConflict, Warehouse, compact, write_facts

YAHOO = S.SOURCES[0]


@pytest.mark.parametrize("block", [1, 7, 19, 20, 64, 100_000])
def test_rolling_means_equal_a_window_whatever_the_blocks(spark, block):
    rng = random.Random(block)
    rows = [(k, n, Decimal(rng.randrange(10_000)) / 100) for k, many in (("a", 150), ("b", 19), ("c", 20), ("d", 1)) for n in range(many)]
    frame = spark.createDataFrame(rows, "key string, at int, value decimal(18,8)").repartition(3)
    found = rolling_means(frame, "key", [F.col("at")], "value", rows_in=20, block=max(block, 19))
    wanted = {}
    for key, at, _ in rows:
        last = [v for k, n, v in rows if k == key and at - 20 < n <= at]
        cents = (sum(last) * 100 / 20 + Decimal("0.5")).to_integral_value("ROUND_FLOOR") / 100
        wanted[key, at] = cents if len(last) == 20 else None
    assert {(r["key"], r["at"]): r["sma"] for r in found.collect()} == wanted
    assert found.columns == ["key", "at", "value", "sma"]


def test_one_long_history_is_spread_over_tasks(spark):
    rows = spark.range(20_000).selectExpr("1 AS key", "id AS at", "CAST(id % 9 AS DECIMAL(18,8)) AS value")
    found = rolling_means(rows, "key", [F.col("at")], "value", block=500)
    held = found.groupBy(F.spark_partition_id()).count().collect()
    assert found.count() == 20_000 and len(held) > 1 and max(r["count"] for r in held) < 15_000
    with pytest.raises(ValueError, match="block"):
        rolling_means(rows, "key", [F.col("at")], "value", block=18)


def test_pages_hold_exactly_their_rows(spark):
    rows = spark.range(1000).selectExpr("id * 7919 % 1000 AS id", "1 AS x").where("id <> 5")
    pages = fact_ops.fact_pages(rows, 100).collect()
    assert sorted((r["page"], r["id"]) for r in pages) == [(n // 100, i) for n, i in enumerate(i for i in range(1000) if i != 5)]


def test_cube_has_every_level(spark, star):
    day = dt.date
    facts, assets, _ = star([(1, day(2020, 1, 1), 1, 5), (1, day(2021, 1, 1), 2, 7), (2, day(2020, 1, 1), 1, 9)])
    found = cube.quote_cube(facts, assets.withColumn("asset_type", F.expr("IF(asset_key = 2, NULL, asset_type)")))
    rows = {(r.asset_type, r.source_key, r.year, r.level): (r.n_quotes, int(r.volume), int(r.low), int(r.high)) for r in found.collect()}
    assert rows[None, None, None, 7] == (3, 6, 5, 9) and rows[None, None, None, 3] == (1, 3, 9, 9)
    assert rows["Stock", None, None, 3] == (2, 3, 5, 7) and rows[None, 1, 2020, 4] == (2, 4, 5, 9)
    assert rows["Stock", 2, 2021, 0] == (1, 2, 7, 7) and len(rows) == len(found.collect()) == 18


def test_sketches_of_loads_equal_one_pass_within_their_errors(spark):
    house = Warehouse.create(spark, shared_dir(spark, "sketches"))
    store = sketches.SketchStore(house)
    assert store.sketches().count() == 0 and store.refresh() == 0
    whole = spark.range(60_000).selectExpr(
        "id", "int(id % 3) AS asset_key", "20240101 + int(id % 28) AS date_key", "1 AS source_key",
        *(f"CAST((id * 7919) % 10007 AS DECIMAL(18,8)) AS {name}_price" for name in ("open", "high", "low", "close")),
        "CAST(1 AS DECIMAL(18,4)) AS volume", "TIMESTAMP_NTZ '2024-06-01 00:00:00' AS loaded_at",
    )
    for load in (1, 2, 3):
        write_facts(house, load, whole.where(f"id % 10 BETWEEN {4 * load - 4} AND {4 * load - 1}"))
        house.commit(Row(load=load, dims_load=0))
        assert store.refresh() == load and store.refresh() == load
    found = sketches.answers(sketches.merged(store.sketches(), "asset_key")).collect()
    at_once = {r["asset_key"]: r for r in sketches.answers(sketches.merged(sketches.sketched(whole), "asset_key")).collect()}
    assert len(found) == 3
    for r in found:
        closes = sorted((n * 7919) % 10007 for n in range(60_000) if n % 3 == r["asset_key"])
        for q in (25, 50, 75):
            for value in (r[f"q{q}"], at_once[r["asset_key"]][f"q{q}"]):
                below, upto = (sum(test(c) for c in closes) / len(closes) for test in (lambda c: c < value, lambda c: c <= value))
                assert below <= q / 100 + sketches.RANK_ERROR and upto >= q / 100 - sketches.RANK_ERROR
        assert r["n_quotes"] == len(closes) and abs(r["n_distinct"] / len(set(closes)) - 1) <= sketches.COUNT_ERROR
        assert r["n_distinct"] == at_once[r["asset_key"]]["n_distinct"]


def quote(ticker, day, close):
    return {"ticker": ticker, "date": f"2024-01-{day:02}", "close": close}


class Overtaken(Warehouse):
    """Lets others load before its own commits."""

    def __init__(self, spark, root, at=None, others=()):
        super().__init__(spark, root, at)
        self.others = others

    def pinned(self):
        return type(self)(self.spark, self.root, self.last["load"], self.others)

    def commit(self, row, replaces=None):
        if self.others:
            self.others.pop(0)()
        super().commit(row, replaces)


@pytest.fixture
def house(spark):
    return Warehouse.create(spark, shared_dir(spark, "rebase"))


def closes(house):
    rows = house.facts().join(house.assets(), "asset_key").collect()
    assert len({(r.asset_key, r.date_key, r.source_key) for r in rows}) == len(rows)
    return {(r.ticker, r.date_key): int(r.close_price) for r in rows}


def test_an_overtaken_load_is_rebased_and_parses_once(spark, house, lake, monkeypatch):
    etl.load_records(house, lake((YAHOO, json.dumps([quote("A", 1, 1), quote("B", 1, 2)]))))
    first = lake((YAHOO, json.dumps([quote("C", 2, 3), quote("B", 2, 4)])), first_id=10)
    second = lake((YAHOO, json.dumps([quote("D", 2, 5), quote("C", 3, 6)])), first_id=20)
    parsed, parse = [], etl.parse.record_outcomes
    monkeypatch.setattr(etl.parse, "record_outcomes", lambda rows: (parsed.append(1), parse(rows))[1])
    others = [lambda: etl.load_records(house, first), lambda: etl.load_records(house, second)]
    mine = lake((YAHOO, json.dumps([quote("E", 2, 7), quote("C", 2, 9), quote("B", 2, 9), quote("C", 3, 9), quote("A", 9, 8)])), first_id=30)
    commit = etl.load_records(Overtaken(spark, house.root, others=others), mine)
    assert (commit.load, commit.facts_loaded, commit.quotes_skipped, len(parsed)) == (4, 2, 3, 3)
    assert closes(house) == {("A", 20240101): 1, ("B", 20240101): 2, ("C", 20240102): 3, ("B", 20240102): 4, ("D", 20240102): 5,
                             ("C", 20240103): 6, ("E", 20240102): 7, ("A", 20240109): 8}
    assets = house.assets().collect()
    assert len({r.asset_key for r in assets}) == len({r.ticker for r in assets}) == 5
    assert house.outcomes().count() == 4


def test_runs_that_another_writer_loaded_are_not_loaded_again(spark, house, lake):
    records = lake((YAHOO, json.dumps(quote("A", 1, 1))))
    others = [lambda: etl.load_records(house, records, runs=["r1"])]
    with pytest.raises(CommitConflict):
        etl.load_records(Overtaken(spark, house.root, others=others), records, runs=["r1"])
    assert closes(house) == {("A", 20240101): 1} and house.outcomes().count() == 1


def test_large_folders_are_left_alone_by_compaction(spark, house, monkeypatch):
    from quotelake.sources import warehouse

    monkeypatch.setattr(warehouse, "SMALL", 4096)

    def load(first, many):
        number = house.last["load"] + 1
        rows = spark.range(first, first + many).selectExpr(
            "id", "int(id) AS asset_key", "20240101 AS date_key", "1 AS source_key",
            *(f"CAST(hash(id) % 100000 AS DECIMAL(18,8)) AS {name}_price" for name in ("open", "high", "low", "close")),
            "CAST(id AS DECIMAL(18,4)) AS volume", "TIMESTAMP_NTZ '2024-06-01 00:00:00' AS loaded_at",
        )
        write_facts(house, number, rows)
        house.commit(Row(load=number, dims_load=0))

    load(0, 50_000)
    for first in range(3):
        load(100_000 + first, 1)
    large, *small = house.last["folders"]["fact_quotes"]
    assert compact(house) == 5
    left = house.last["folders"]["fact_quotes"]
    assert left[0] == large and len(left) == 2 and not set(small) & set(left)
    assert house.facts().count() == 50_003 and compact(house, least=2) is None
    assert house.facts(after_load=3).count() == 1 and house.facts(after_load=4).inputFiles() == []


def test_file_system_calls_do_not_grow_with_commits_and_runs(spark, house, lake, monkeypatch):
    from quotelake.sources import files

    for number in range(1, 40):
        house.commit(Row(load=number, dims_load=0))
    calls, exists = [], files.exists
    monkeypatch.setattr(files, "exists", lambda *a: (calls.append(a[1]), exists(*a))[1])
    assert house.last["load"] == 39
    calls.clear()
    assert house.last["load"] == 39 and len(calls) == 1
    calls.clear()
    assert Warehouse(spark, house.root).last["load"] == 39 and len(calls) < 15
