"""The benchmark tables read as this package's model.

The tables hold no market data, so order lines stand in for quotes, parts for assets and
events for lake records. All of it is projection over whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.calendar import calendar_columns, date_key, key_year, stamp
from quotelake.operators.dedup import first_wins
from quotelake.operators.facts import to_facts
from quotelake.sources.payloads import PAYLOADS

# Ties in the batch order fall to the values themselves: then they are the same quote.
LINE_VALUES = ("l_extendedprice", "l_quantity", "l_discount", "l_tax")
LINE_ORDER = (*S.BATCH_ORDER, *LINE_VALUES)

# Assets smaller than this are inactive.
ACTIVE_FROM_SIZE = 6
# Source names, in key order starting at 1.
LINE_SOURCES = ("A", "N", "R")
# Events before this day count as processed in earlier runs.
PROCESSED_BEFORE = dt.datetime(2024, 1, 8)
CREATED = dt.datetime(1995, 1, 1)
# Chart stamps are taken at 14:30 UTC.
CHART_SECOND = 52_200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def assets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "int(p_partkey) AS asset_key",
        "concat('P', p_partkey) AS ticker",
        "p_name AS name",
        "p_type AS asset_type",
        "CAST(NULL AS STRING) AS exchange",
        f"p_size >= {ACTIVE_FROM_SIZE} AS is_active",
        f"{stamp(CREATED)} AS created_at",
        f"{stamp(CREATED)} AS updated_at",
    )


def sources(spark: SparkSession) -> DataFrame:
    names = ", ".join(f"'{name}'" for name in LINE_SOURCES)
    return spark.range(1, numPartitions=1).selectExpr(f"posexplode(array({names}))").selectExpr(
        "pos + 1 AS source_key", "col AS source_name", "'' AS base_url", "true AS is_active"
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS date")
    return days.distinct().selectExpr(*calendar_columns("date"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the keys and the place in the batch of the quotes they stand for."""
    cases = " ".join(f"WHEN '{name}' THEN {key}" for key, name in enumerate(LINE_SOURCES, start=1))
    return table(spark, folder, "lineitem").selectExpr(
        "int(l_partkey) AS asset_key",
        f"{date_key('l_shipdate')} AS date_key",
        f"CASE l_returnflag {cases} END AS source_key",
        "l_shipdate + make_dt_interval(l_linenumber) AS loaded_at",
        "l_orderkey AS record_id",
        "l_linenumber AS element_pos",
        "*",
    )


def _as_quotes(lines: DataFrame) -> DataFrame:
    price = "CAST(l_extendedprice AS DECIMAL(12,2))"
    low = f"CAST({price} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,8))"
    high = f"CAST({price} * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,8))"
    return lines.selectExpr(
        *S.FACT_KEY,
        "concat('P', l_partkey) AS ticker",
        "CAST(l_shipdate AS DATE) AS date",
        f"{low} AS open",
        f"{high} AS high",
        f"{low} AS low",
        f"CAST({price} AS DECIMAL(18,8)) AS close",
        "CAST(l_quantity AS DECIMAL(18,4)) AS volume",
        "l_returnflag AS source",
        *S.BATCH_ORDER,
        "l_linestatus AS status",
        *LINE_VALUES,
    )


def keyed_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """One quote per order line, with the keys the tables already hold: the price is the
    close, discount and tax make the range."""
    return _as_quotes(_lines(spark, folder))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    """The quotes without keys."""
    return keyed_quotes(spark, folder).select(*S.QUOTES.fieldNames(), "status", *LINE_VALUES)


def facts(spark: SparkSession, folder: str, since: str | None = None) -> DataFrame:
    """The quote fact: the first quote of each asset, date and source, from the day
    ``since`` (SQL) on if given, which the file scan then tests.

    The line is chosen before its numbers are made decimals, so a query makes only the
    ones it reads.
    """
    lines = _lines(spark, folder)
    if since:
        lines = lines.where(f"l_shipdate >= CAST({since} AS TIMESTAMP_NTZ)")
    return to_facts(_as_quotes(first_wins(lines, S.FACT_KEY, LINE_ORDER)))


def last_day(spark: SparkSession, folder: str) -> dt.date:
    """The newest quote date: "today" for these tables. One value reaches the driver."""
    return table(spark, folder, "lineitem").selectExpr("CAST(max(l_shipdate) AS DATE)").first()[0]


def lake(spark: SparkSession, folder: str) -> DataFrame:
    """One lake record per event; the event type decides what is right or wrong with it."""
    price = "CAST(value AS DECIMAL(18,2))"
    head = """'{"ticker":"U', user_id, '","date":"', CAST(ts AS DATE), '"'"""
    prices = ", ".join(f"""',"{name}":', {price}""" for name in ("open", "high", "low", "close"))
    full = f"""{head}, {prices}, ',"volume":1}}'"""
    content = f"""CASE event_type
        WHEN 'click' THEN concat('[{{"ticker":" ","date":"2024-01-01"}},', {full}, ']')
        WHEN 'signup' THEN concat({head}, ',"close":', {price}, '}}')
        WHEN 'purchase' THEN concat('[', {full}, ',', {head}, ',"close":null}}]')
        WHEN 'error' THEN concat('[', {full})
        ELSE concat('[', {full}, ']') END"""
    source = f"""CASE event_type WHEN 'click' THEN '{S.YAHOO.lower()}' WHEN 'view' THEN 'UnknownFeed'
        WHEN 'signup' THEN '{S.COINGECKO}' ELSE '{S.YAHOO}' END"""
    return table(spark, folder, "events").selectExpr(
        "event_id AS record_id",
        f"{source} AS source",
        f"{source} AS endpoint",
        f"{content} AS raw_content",
        "ts AS loaded_at",
        f"ts < {stamp(PROCESSED_BEFORE)} AS is_processed",
    )


def faulty_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One lake record per event, each with one of seven faults by its id."""
    ticker = "concat('V', user_id)"
    day = "string(CAST(ts AS DATE))"
    text_price = "'\"8\"'"

    def quote(ticker: str = ticker, day: str = day, close: str = "'7.5'") -> str:
        return f"""concat('{{"ticker":"', {ticker}, '","date":"', {day}, '","close":', {close}, '}}')"""

    content = f"""CASE event_id % 7
        WHEN 0 THEN concat('[', {quote()}, ',', {quote(close="'12345678901.5'")}, ']')
        WHEN 1 THEN concat('[', {quote(ticker="repeat('W', 21)")}, ',', {quote()}, ']')
        WHEN 2 THEN concat('[{{"date":"', {day}, '","close":1}}]')
        WHEN 3 THEN concat('[', {quote(close=text_price)}, ']')
        WHEN 4 THEN concat('[', {quote()}, ',{{"ticker":null,"date":"', {day}, '","close":2}}]')
        WHEN 5 THEN concat('[', {quote(day="'soon'")}, ',', {quote()}, ']') END"""
    return table(spark, folder, "events").selectExpr(
        "event_id AS record_id",
        f"'{S.YAHOO}' AS source",
        f"'{S.YAHOO}' || CASE event_id % 7 WHEN 6 THEN '/' || event_id ELSE '' END AS endpoint",
        f"{content} AS raw_content",
        "ts AS loaded_at",
        "false AS is_processed",
    )


def chart_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The facts as chart payloads, one per asset, source and year.

    A payload holds at most one quote per day of its year, so its size is bounded. A price
    equal to the close is sent as null.
    """
    other = ", ".join(
        f"'{name}', CASE WHEN {name}_price <> close_price THEN {name}_price END"
        for name in ("open", "high", "low")
    )
    point = (
        "named_struct('day', bigint(unix_date(to_date(string(date_key), 'yyyyMMdd'))), "
        f"{other}, 'close', close_price, 'volume', volume)"
    )
    payloads = (
        facts(spark, folder)
        .selectExpr("asset_key", "source_key", f"{key_year('date_key')} AS year", f"{point} AS point")
        .groupBy("asset_key", "source_key", "year")
        .agg(F.expr("array_sort(collect_list(point))").alias("points"))
    )
    series = ", ".join(
        f"'{name}', transform(points, p -> p.{name})" for name in ("open", "high", "low", "close", "volume")
    )
    stamps = f"transform(points, p -> p.day * 86400 + {CHART_SECOND})"
    result = (
        f"named_struct('timestamp', {stamps}, "
        f"'indicators', named_struct('quote', array(named_struct({series}))))"
    )
    return payloads.selectExpr(
        "(bigint(asset_key) * 10 + source_key) * 10000 + year AS payload_id",
        f"'{S.YAHOO}' AS source",
        "concat('P', asset_key) AS ticker",
        f"to_json(named_struct('chart', named_struct('result', array({result})))) AS payload",
        "make_timestamp_ntz(year + 1, 1, 1, 0, 0, 0) AS loaded_at",
    ).select(*PAYLOADS.fieldNames())


def pair_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Events as pair payloads, one per user and month.

    The price of a day is its highest value and the volume its number of events, so a
    payload has at most 31 pairs. For every fourth user the volume of the newest day is not
    out yet.
    """
    daily = (
        table(spark, folder, "events")
        .selectExpr("user_id", "CAST(ts AS DATE) AS day", "value")
        .groupBy("user_id", "day")
        .agg(F.max("value").alias("price"), F.count("*").alias("n"))
    )
    point = "named_struct('millis', unix_date(day) * 86400000L, 'price', CAST(price AS DECIMAL(18,2)), 'n', n)"
    monthly = (
        daily.selectExpr("user_id", "trunc(day, 'month') AS month", f"{point} AS point")
        .groupBy("user_id", "month")
        .agg(F.expr("array_sort(collect_list(point))").alias("points"))
    )

    def pairs(points: str, name: str) -> str:
        return f"array_join(transform({points}, p -> concat('[', p.millis, ',', p.{name}, ']')), ',')"

    known = "IF(user_id % 4 = 0, slice(points, 1, size(points) - 1), points)"
    return monthly.selectExpr(
        "user_id * 1000000 + year(month) * 100 + month(month) AS payload_id",
        f"'{S.COINGECKO}' AS source",
        "concat('u', user_id) AS ticker",
        f"""concat('{{"prices":[', {pairs('points', 'price')}, '],"total_volumes":[',
            {pairs(known, 'n')}, ']}}') AS payload""",
        "CAST(add_months(month, 1) AS TIMESTAMP_NTZ) AS loaded_at",
    )


def watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """A watchlist over all parts: the type decides the source, and one source is disabled."""
    source = """CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'A' WHEN p_type = 'STANDARD' THEN 'N'
        ELSE 'R' END"""
    return table(spark, folder, "part").selectExpr(
        f"{source} AS source", "concat('P', p_partkey) AS ticker", f"{source} <> 'R' AS enabled"
    )


def asked(spark: SparkSession, folder: str) -> DataFrame:
    """What every order line asks for: its part's quote so many days before it shipped as its
    line number says."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "int(l_partkey) AS asset_key",
        "date_sub(CAST(l_shipdate AS DATE), l_linenumber) AS day", "CAST(l_quantity AS DECIMAL(18,4)) AS quantity",
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """One tick of the user's ticker per event."""
    return table(spark, folder, "events").selectExpr(
        "concat('U', user_id) AS ticker", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "event_id AS seq",
        "CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,8)) AS price", "CAST(1 AS DECIMAL(18,4)) AS volume",
        "event_type",
    )


def thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """A threshold for every user's ticker, and a second one for users with even ids."""
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.selectExpr(
        "concat('U', user_id) AS ticker", "explode(IF(user_id % 2 = 0, array(30, 100), array(30))) AS threshold"
    ).selectExpr("ticker", "CAST(threshold AS DECIMAL(18,8)) AS threshold")


# Days on which the asset dimension changed, and what became of it since.
ASSET_CHANGES = (
    (dt.date(1994, 6, 15), "asset_type", "IF(asset_key % 3 = 0, concat(asset_type, ' II'), asset_type)"),
    (dt.date(1996, 3, 1), "name", "IF(asset_key % 2 = 0, upper(name), name)"),
    (dt.date(1997, 1, 1), "is_active", "IF(asset_key % 6 = 0, NOT is_active, is_active)"),
)


def asset_states(spark: SparkSession, folder: str) -> list[tuple[dt.date, DataFrame]]:
    """The asset dimension as it was first, and after each change."""
    found = [(dt.date(1992, 1, 1), assets(spark, folder))]
    for day, name, value in ASSET_CHANGES:
        found.append((day, found[-1][1].withColumn(name, F.expr(value))))
    return found
