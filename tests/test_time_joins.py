"""As-of joins and interval joins against plain loops."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from quotelake.operators import asof, versions
from quotelake.operators.asof import asof_join
from quotelake.operators.intervals import valid_at
from quotelake.operators.numbering import numbered
from quotelake.sources.warehouse import no_rows

LEFT = "n int, key string, at int, value string, k string, part int, side int, own string"
RIGHT = "key string, at int, rank int, price int"


def brute(left, right):
    out = []
    for row in left:
        fits = [r for r in right if r[0] is not None and r[0] == row[1] and r[1] is not None and row[2] is not None and r[1] <= row[2]]
        best = max(fits, key=lambda r: (r[1], r[2], r[3]), default=None)
        out.append((*row, best[2] if best else None, best[3] if best else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(9)
    keys = ["hot"] * 12 + ["warm"] * 4 + [f"k{n}" for n in range(20)] + [None]
    left = [(n, rng.choice(keys), rng.choice((None, *range(200))), "v", "k", 1, 2, "o") for n in range(900)]
    right = [(rng.choice(keys), rng.choice((None, *range(200))), rng.randrange(3), rng.randrange(50)) for _ in range(700)]
    left += [(2000 + n, "only left", 7, "v", "k", 1, 2, "o") for n in range(50)] + [left[0], left[0]]
    right += [("only right", 3, 1, 1), ("gap", 1, 1, 42)]
    # Quotes of one key, then many rows without any: the quote is carried over many ranges.
    left += [(3000 + n, "gap", 2 + n, "v", "k", 1, 2, "o") for n in range(300)]
    return left, right


@pytest.mark.parametrize("hot_rows, parts", [(10**6, None), (100, 7), (0, 1), (0, 5), (0, 40)])
def test_asof(spark, sides, hot_rows, parts):
    left, right = sides
    found = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "key", "at", ["rank", "price"],
        tie=["rank", "price"], hot_rows=hot_rows, parts=parts,
    )
    assert found.columns == [*re.findall(r"(\w+) \w+,?", LEFT), "rank", "price"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(left, right)


@pytest.mark.parametrize("hot_rows, parts", [(0, 1), (0, 7), (30, 5)])
def test_asof_with_more_hot_keys_than_can_be_broadcast(spark, sides, hot_rows, parts, monkeypatch):
    monkeypatch.setattr(asof, "MAX_BROADCAST_ROWS", 2)
    left, right = sides
    found = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "key", "at", ["rank", "price"],
        tie=["rank", "price"], hot_rows=hot_rows, parts=parts,
    )
    assert sorted(map(tuple, found.collect()), key=repr) == brute(left, right)


@pytest.mark.parametrize("hot_rows", [0, 10])
def test_asof_with_an_empty_side(spark, sides, hot_rows):
    left, right = spark.createDataFrame(sides[0], LEFT), spark.createDataFrame(sides[1], RIGHT)
    found = asof_join(left, right.limit(0), "key", "at", ["price"], hot_rows=hot_rows)
    assert found.count() == left.count() and found.where("price IS NOT NULL").count() == 0
    assert asof_join(left.limit(0), right, "key", "at", ["price"], hot_rows=hot_rows).collect() == []


def test_asof_makes_no_pairs_and_spreads_a_hot_key(spark):
    rows = spark.range(40_000).selectExpr("IF(id % 3 > 0, 'hot', string(id)) AS key", "id AS at", "id AS price")
    found = asof_join(rows.select("key", "at"), rows.where("at % 7 = 0"), "key", "at", ["price"], hot_rows=5000, parts=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|SortMergeJoin|ShuffledHashJoin", plan)
    assert found.where("key = 'hot'").groupBy(F.spark_partition_id()).count().count() > 1
    assert found.count() == 40_000
    # Every hot row from 7 on has a quote of its own key less than 21 before it.
    assert found.where("key = 'hot' AND at >= 7 AND (price <= at AND at - price < 21) IS NOT TRUE").count() == 0


def test_asof_refuses_clashing_names(spark):
    rows = spark.createDataFrame([("a", 1, 2)], "key string, at int, price int")
    with pytest.raises(ValueError, match="price"):
        asof_join(rows, rows, "key", "at", ["price"])


def test_numbers_are_gapless_in_order(spark):
    rows = spark.range(5000).selectExpr("id", "IF(id % 3 = 0, 1, id * 7919 % 1000) AS v", "1 AS place")
    found = numbered(rows, [F.desc("v"), F.asc("id")], parts=7).collect()
    assert sorted(r["number"] for r in found) == list(range(5000))
    ordered = sorted(found, key=lambda r: r["number"])
    assert [(r["v"], r["id"]) for r in ordered] == sorted(((r["v"], r["id"]) for r in found), key=lambda x: (-x[0], x[1]))
    assert numbered(rows.limit(0), [F.asc("id")]).collect() == []
    with pytest.raises(ValueError):
        numbered(rows, [F.asc("id")], name="v")


D = dt.date


def test_every_day_meets_its_version(spark):
    told = [(1, "a", D(1, 1, 1), D(2000, 5, 5)), (1, "b", D(2000, 5, 5), D(2000, 5, 6)), (1, "c", D(2000, 5, 6), None),
            (2, "x", D(1999, 1, 1), D(2001, 12, 31)), (3, "gone", D(1, 1, 1), D(1980, 1, 1))]
    held = spark.createDataFrame(told, "asset int, name string, valid_from date, valid_to date")
    days = [D(1999, 12, 31), D(2000, 5, 4), D(2000, 5, 5), D(2000, 5, 6), D(2001, 12, 30), D(2001, 12, 31), D(2030, 1, 1), None]
    rows = spark.createDataFrame([(a, day) for a in (1, 2, 3, 4) for day in days], "asset int, day date")
    found = valid_at(rows, held, "asset", "day")
    wanted = [(a, day, n, f, t) for a in (1, 2, 3, 4) for day in days for b, n, f, t in told
              if a == b and day and f <= day and (t is None or day < t)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert found.where("asset = 1").count() == 7
    assert valid_at(rows.limit(0), held, "asset", "day").collect() == []
    with pytest.raises(ValueError, match="day"):
        valid_at(rows, held.withColumn("day", F.lit(1)), "asset", "day")


def test_version_history(spark, star):
    _, assets, _ = star([(a, D(2020, 1, 1), 1, 1) for a in (1, 2, 3)])
    first = D(1, 1, 1)
    history = versions.with_batch(no_rows(spark, versions.VERSIONS), assets.where("asset_key < 3"), D(2020, 1, 1))
    renamed = assets.withColumn("name", F.expr("IF(asset_key = 1, 'new', name)"))
    history = versions.with_batch(history, renamed, D(2021, 2, 3))
    history = versions.with_batch(history, renamed.where("asset_key <> 2"), D(2021, 2, 4))
    again = renamed.withColumn("name", F.expr("IF(asset_key = 1, 'newer', name)"))
    history = versions.with_batch(history, again, D(2022, 1, 1))
    history = versions.with_batch(history, again.withColumn("exchange", F.expr("IF(asset_key = 1, 'X', exchange)")), D(2022, 1, 1))
    found = sorted((r.asset_key, r.name, r.exchange, r.valid_from, r.valid_to) for r in history.collect())
    assert found == [
        (1, "Name 1", None, first, D(2021, 2, 3)), (1, "new", None, D(2021, 2, 3), D(2022, 1, 1)),
        (1, "newer", "X", D(2022, 1, 1), None), (2, "Name 2", None, first, None), (3, "Name 3", None, first, None),
    ]
    with pytest.raises(Exception, match="later version"):
        versions.with_batch(history, renamed, D(2021, 1, 1)).collect()
