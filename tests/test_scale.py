"""Plans and results under skew: one key may hold a third of the rows."""

from __future__ import annotations

import datetime as dt

import pytest

from quotelake import queries
from quotelake import schemas as S
from quotelake.operators import dedup, series
from quotelake.operators.bounded import fits
from quotelake.plans import marts

FOLDER = "/root/testdata/sf0.001"


def plan(rows, capsys):
    capsys.readouterr()
    rows.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_no_query_pairs_all_rows(spark, capsys, name):
    text = plan(queries.queries()[name](spark, FOLDER), capsys)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.fixture
def hot(spark):
    """Facts where asset 0 holds a third of the rows, 200 sources a day."""
    rows = spark.range(30_000).selectExpr(
        "id",
        "int(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 997 END) AS asset_key",
        "int(20240101 + id % 28) AS date_key",
        "int(id % 200) AS source_key",
        *(f"CAST(id % 1000 + 1 AS DECIMAL(18,8)) AS {name}_price" for name in ("open", "high", "low", "close")),
        "CAST(1 AS DECIMAL(18,4)) AS volume",
        "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS loaded_at",
    )
    return rows


def test_dedup_limits_each_key_before_the_exchange(hot, capsys):
    kept = dedup.first_wins(hot, S.FACT_KEY, ["id"])
    text = plan(kept, capsys)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    firsts = hot.groupBy(*S.FACT_KEY).agg({"id": "min"}).collect()
    assert sorted(r.id for r in kept.collect()) == sorted(r["min(id)"] for r in firsts)


def test_latest_days_are_limited_before_the_exchange(hot, capsys):
    text = plan(series.last_two_days(hot), capsys)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.index("Partial")


def test_screener_combines_before_the_exchange(hot, capsys, spark):
    assets = spark.range(1000).selectExpr(
        "int(id) AS asset_key", "concat('T', id) AS ticker", "'n' AS name", "'Stock' AS asset_type", "true AS is_active"
    )
    text = plan(marts.week52_high_low(hot, assets, dt.date(2024, 2, 1), ordered=False), capsys)
    assert "partial_max_by" in text and "SortAggregate" not in text and "Window" not in text


def test_quotes_are_not_exchanged_for_the_comparison(hot, capsys, spark):
    assets = spark.range(1000).selectExpr(
        "int(id) AS asset_key", "concat('T', id) AS ticker", "'n' AS name", "'Stock' AS asset_type", "true AS is_active"
    )
    text = plan(marts.comparative_returns(hot, assets, 90, dt.date(2024, 2, 1), ordered=False), capsys)
    assert "BroadcastHashJoin [asset_key" in text and "SortMergeJoin" not in text


def test_size_check_decides_the_broadcast(spark, hot, capsys, monkeypatch):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10)
    assets = spark.range(1000).selectExpr(
        "int(id) AS asset_key", "concat('T', id) AS ticker", "'n' AS name", "'Stock' AS asset_type", "true AS is_active"
    )
    day = dt.date(2024, 2, 1)
    small = marts.comparative_returns(hot, assets, 90, day).collect()
    monkeypatch.setattr(marts, "fits", lambda keys: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = marts.comparative_returns(hot, assets, 90, day)
        assert "SortMergeJoin" in plan(large, capsys)
        assert large.collect() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_a_large_dimension_are_not_broadcast(spark, capsys):
    from quotelake.operators.dims import with_keys

    quotes = spark.range(1000).selectExpr("concat('U', id * 150) AS ticker", "IF(id < 0, 'B', 'A') AS source", "DATE '2024-01-15' AS date")
    assets = spark.range(150_000).selectExpr("concat('U', id) AS ticker", "int(id) AS asset_key")
    sources = spark.range(2).selectExpr("IF(id = 0, 'A', 'B') AS source_name", "int(id) AS source_key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = with_keys(quotes, assets, sources)
        text = plan(keyed, capsys)
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
        assert plan(with_keys(quotes, assets.limit(1000), sources), capsys).count("BroadcastHashJoin") == 2
        assert sorted(r.asset_key for r in keyed.collect()) == [n * 150 for n in range(1000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_facts_are_pruned_by_year_and_key(spark, star, capsys):
    from quotelake.session import shared_dir
    from quotelake.sources.warehouse import Warehouse, write_facts
    from pyspark.sql import Row

    facts, assets, _ = star([(1, dt.date(year, 6, 1), 1, 5) for year in (2021, 2022, 2023, 2024)])
    house = Warehouse.create(spark, shared_dir(spark, "house"))
    write_facts(house, 1, facts)
    house.write("dim_assets", 1, assets)
    house.commit(Row(load=1, dims_load=1))
    text = plan(marts.comparative_returns(house.facts(), house.assets(), 90, dt.date(2024, 7, 1)), capsys)
    assert "year" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(date_key,20240402)" in text
    assert marts.comparative_returns(house.facts(), house.assets(), 90, dt.date(2024, 7, 1)).count() == 1


def test_a_small_batch_leaves_stored_facts_where_they_lie(spark, hot, capsys):
    from quotelake.operators.facts import only_new

    batch = hot.limit(5)
    text = plan(only_new(batch.selectExpr("*"), hot), capsys)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_source_keys_that_do_not_fit_fail(spark):
    from quotelake.operators.keys import fact_id

    row = spark.range(1).selectExpr("1 AS a", "20240101 AS d", "1024 AS s")
    with pytest.raises(Exception, match="source key above 1023"):
        row.selectExpr(fact_id("a", "d", "s")).collect()
