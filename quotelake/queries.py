"""Every query by name, over a folder of the benchmark tables.

``plain`` gives results the types both engines of the check share: doubles for decimals,
text for dates and stamps. The queries themselves compute on decimals and dates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions.calendar import key_date, look_back
from quotelake.operators import dims, facts, parse, quality, series, versions
from quotelake.operators.asof import asof_join
from quotelake.operators.intervals import valid_at
from quotelake.operators.keys import fact_id
from quotelake.plans import analytics, cube, etl, kept, marts, sketches
from quotelake.session import shared_dir, staged
from quotelake.sources import lake as lakes
from quotelake.sources import payloads as feeds
from quotelake.sources import tables
from quotelake.sources.warehouse import Warehouse, compact, no_rows, write_facts
from quotelake.streaming import alerts, bars, ingest

Query = Callable[[SparkSession, str], DataFrame]

NOW = dt.datetime(2024, 2, 1)
# The stored part of the fact where a query needs stored and incoming facts.
STORED_STATUS = "F"
STORED_BEFORE = 19990101

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain(rows: DataFrame) -> DataFrame:
    forms = {
        "date": "string({0}) AS {0}",
        "timestamp_ntz": "substr(string({0}), 1, 19) AS {0}",
    }
    return rows.selectExpr(
        *(
            forms.get(kind, "double({0}) AS {0}" if kind.startswith("decimal") else "{0}").format(name)
            for name, kind in rows.dtypes
        )
    )


# Marts


def _compare(
    spark: SparkSession, folder: str, days: int = 90
) -> tuple[DataFrame, DataFrame, int, dt.date]:
    as_of = tables.last_day(spark, folder)
    facts_in_range = tables.facts(spark, folder, look_back(as_of, days))
    return facts_in_range, tables.assets(spark, folder), days, as_of


@_query
def portfolio_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.portfolio_summary(tables.facts(spark, folder), tables.assets(spark, folder)))


@_query
def portfolio_summary_rowprev(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.portfolio_summary(tables.facts(spark, folder), tables.assets(spark, folder), "row"))


@_query
def daily_performance(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.daily_performance(tables.facts(spark, folder), tables.assets(spark, folder)))


@_query
def daily_performance_rowprev(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.daily_performance(tables.facts(spark, folder), tables.assets(spark, folder), "row"))


def _star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tables.facts(spark, folder), tables.assets(spark, folder), tables.dates(spark, folder)


@_query
def asset_history_view(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.asset_history_view(*_star(spark, folder)))


@_query
def asset_history(spark: SparkSession, folder: str) -> DataFrame:
    """The history page of every active asset."""
    return plain(marts.asset_histories(*_star(spark, folder), days=30))


@_query
def asset_history_one(spark: SparkSession, folder: str) -> DataFrame:
    """The history page of the first active ticker, whose wish for 1000 rows is clamped."""
    quotes, assets, dates = _star(spark, folder)
    ticker = assets.where("is_active").agg({"ticker": "min"}).first()[0]
    return plain(marts.asset_history(quotes, assets, dates, ticker, 1000))


@_query
def comparative_returns(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.comparative_returns(*_compare(spark, folder)))


@_query
def comparative_returns_year(spark: SparkSession, folder: str) -> DataFrame:
    """The longest window a user may ask for."""
    return plain(marts.comparative_returns(*_compare(spark, folder, marts.YEAR_DAYS)))


def _week52(spark: SparkSession, folder: str, ordered: bool = True) -> DataFrame:
    as_of = tables.last_day(spark, folder)
    return marts.week52_high_low(
        tables.facts(spark, folder), tables.assets(spark, folder), as_of, ordered
    )


@_query
def week52_high_low(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_week52(spark, folder))


@_query
def latest_close(spark: SparkSession, folder: str) -> DataFrame:
    return plain(series.latest_close(tables.facts(spark, folder)))


# Pages


@_query
def asset_sma(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.asset_sma(marts.asset_histories(*_star(spark, folder), days=365)))


@_query
def asset_header(spark: SparkSession, folder: str) -> DataFrame:
    """The header of every asset; inactive ones are not in the summary and show defaults."""
    assets = tables.assets(spark, folder)
    summary = marts.portfolio_summary(tables.facts(spark, folder), assets, ordered=False)
    return plain(analytics.asset_header(summary, assets))


@_query
def compare_grid(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.compare_grid(*_compare(spark, folder)))


@_query
def compare_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.compare_pivot(*_compare(spark, folder)))


@_query
def compare_series(spark: SparkSession, folder: str) -> DataFrame:
    """The maps as text: date=value entries in date order."""
    rows = analytics.compare_series(*_compare(spark, folder))
    entry = "concat(e.key, '=', CAST(e.value AS DECIMAL(20,2)))"
    return rows.selectExpr(
        "ticker", f"array_join(transform(map_entries(series), e -> {entry}), ';') AS series"
    )


@_query
def compare_tickers(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.compare_tickers(marts.comparative_rows(*_compare(spark, folder))))


@_query
def compare_dates(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.compare_dates(marts.comparative_rows(*_compare(spark, folder))))


@_query
def week52_position(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.week52_position(_week52(spark, folder)))


@_query
def week52_display(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.week52_display(analytics.week52_position(_week52(spark, folder)))


@_query
def portfolio_display(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.portfolio_display(
        marts.portfolio_summary(tables.facts(spark, folder), tables.assets(spark, folder))
    )


@_query
def history_display(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.history_display(marts.asset_histories(*_star(spark, folder), days=30))


# Dimensions


@_query
def active_assets(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dims.active_assets(tables.assets(spark, folder)))


@_query
def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The asset of every order key read as a ticker; most have none."""
    wanted = tables.table(spark, folder, "orders").selectExpr("concat('P', o_orderkey) AS ticker")
    found = dims.lookup(tables.assets(spark, folder), "ticker", wanted)
    return plain(found.withColumn("is_active", found["is_active"].cast("string")))


@_query
def dim_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Date rows that quotes and events together need."""
    events = tables.table(spark, folder, "events").selectExpr("CAST(ts AS DATE) AS date")
    wanted = tables.quotes(spark, folder).select("date").union(events)
    stored = no_rows(spark, S.DIM_DATES)
    return plain(dims.missing_dates(stored, wanted))


@_query
def dim_dates_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates that the date dimension of the quotes lacks."""
    wanted = tables.table(spark, folder, "orders").selectExpr("CAST(o_orderdate AS DATE) AS date")
    return plain(dims.missing_dates(tables.dates(spark, folder), wanted))


def _all_quotes(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.quotes(spark, folder).select(*S.QUOTES.fieldNames())
    return lines.unionByName(parse.parsed_quotes(parse.record_outcomes(tables.lake(spark, folder))))


@_query
def dim_assets_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Parts updated by the order lines, with the tickers of the lake added."""
    incoming = staged(dims.assets_in(_all_quotes(spark, folder)), "batch-assets")
    return plain(dims.upsert_assets(tables.assets(spark, folder), incoming, NOW))


@_query
def dim_sources_upsert(spark: SparkSession, folder: str) -> DataFrame:
    incoming = staged(dims.sources_in(_all_quotes(spark, folder)), "batch-sources")
    return plain(dims.upsert_sources(tables.sources(spark), incoming))


# Facts


@_query
def fact_build(spark: SparkSession, folder: str) -> DataFrame:
    """All quotes with the keys looked up in the dimensions."""
    keyed = dims.with_keys(
        tables.quotes(spark, folder), tables.assets(spark, folder), tables.sources(spark)
    )
    return plain(facts.to_facts(keyed))


@_query
def fact_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return plain(tables.facts(spark, folder))


@_query
def fact_dedup_last(spark: SparkSession, folder: str) -> DataFrame:
    return plain(facts.last_facts(tables.keyed_quotes(spark, folder), tables.LINE_ORDER))


def _split_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The facts of an order's lines from the third on as incoming ones, those of its lines up
    to the fourth as the stored ones: keys of either kind are on every day."""
    quotes = tables.keyed_quotes(spark, folder)
    stored, incoming = (
        facts.first_facts(quotes.where(part), tables.LINE_ORDER) for part in ("element_pos <= 4", "element_pos >= 3")
    )
    return staged(incoming, "incoming"), staged(stored, "stored")


@_query
def fact_new_only(spark: SparkSession, folder: str) -> DataFrame:
    return plain(facts.only_new(*_split_facts(spark, folder)))


@_query
def fact_existing(spark: SparkSession, folder: str) -> DataFrame:
    return plain(facts.already_stored(*_split_facts(spark, folder)))


def _two_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    quotes = tables.keyed_quotes(spark, folder)
    return quotes.where(f"status = '{STORED_STATUS}'"), quotes.where(f"status <> '{STORED_STATUS}'")


@_query
def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    """What the second of two batches adds to the facts of the first."""
    first, second = _two_batches(spark, folder)
    added = facts.facts_to_add(
        second.drop(*S.FACT_KEY),
        tables.assets(spark, folder),
        tables.sources(spark),
        facts.first_facts(first, tables.LINE_ORDER),
        tables.LINE_ORDER,
        NOW,
    )
    return plain(added)


@_query
def fact_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches where a later load of a key replaces the stored one; the batch that
    holds the key's newest quote wins, and between equals the stored one."""
    first, second = _two_batches(spark, folder)
    stored = facts.last_facts(first, tables.LINE_ORDER)
    incoming = facts.last_facts(second, tables.LINE_ORDER)
    return plain(facts.replace_facts(stored, incoming))


@_query
def fact_delta_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The facts of one snapshot behind a last id, which here lies inside the first asset."""
    last = spark.range(1).selectExpr(fact_id("0", str(STORED_BEFORE), "0")).first()[0]
    return plain(facts.facts_after(tables.facts(spark, folder), last))


@_query
def publish_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The loaded lake published, and the published tables joined again."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    etl.load_records(house, tables.lake(spark, folder), now=NOW)
    target = shared_dir(spark, "published")
    etl.publish(house, target)
    fact, assets, sources, days = (
        etl.published(spark, target, name)
        for name in ("fact_quotes", "dim_assets", "dim_sources", "dim_dates")
    )
    return plain(
        fact.join(assets.select("asset_key", "ticker", "exchange", "is_active"), "asset_key")
        .join(sources.select("source_key", "source_name"), "source_key")
        .join(days.select("date_key", "is_weekend"), "date_key")
        .select("ticker", "source_name", "is_active", "exchange", "date_key", "is_weekend", "close_price", "volume")
    )


@_query
def publish_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return plain(etl.replica(tables.assets(spark, folder)))


@_query
def publish_added(spark: SparkSession, folder: str) -> DataFrame:
    """The lake loaded and published in two steps: the facts each version copied."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake, target = tables.lake(spark, folder), shared_dir(spark, "published")
    for part in ("is_processed", "NOT is_processed"):
        etl.load_records(house, lake.where(part), now=NOW)
        etl.publish(house, target)
    rows = etl.published(spark, target, "fact_quotes")
    return rows.selectExpr(
        "int(regexp_extract(_metadata.file_path, 'version=([0-9]+)-', 1)) AS version"
    ).groupBy("version").count().withColumnRenamed("count", "n_facts")


# Data quality


@_query
def dq_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """All unique and reference rules of the star schema over the quotes as they come."""
    quotes = tables.keyed_quotes(spark, folder)
    assets, dates, sources = (
        tables.assets(spark, folder), tables.dates(spark, folder), tables.sources(spark)
    )
    wanted = tables.table(spark, folder, "orders").selectExpr("CAST(o_orderdate AS DATE) AS full_date")
    return quality.constraint_counts(
        unique={
            "dim_assets.ticker": (assets, ["ticker"]),
            "dim_dates.full_date": (dates, ["full_date"]),
            "dim_sources.source_name": (sources, ["source_name"]),
            "orders.full_date": (wanted, ["full_date"]),
            "fact_quotes.key": (quotes, S.FACT_KEY),
        },
        references={
            "fact_quotes.asset_key": (quotes, assets, "asset_key"),
            "fact_quotes.date_key": (quotes, dates, "date_key"),
            "fact_quotes.source_key": (quotes, sources.where("source_key > 1"), "source_key"),
        },
    )


@_query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that the quotes repeat, which the fact must not."""
    return quality.duplicate_keys(tables.keyed_quotes(spark, folder), S.FACT_KEY)


@_query
def dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Facts whose asset is not among the active ones."""
    active = tables.assets(spark, folder).where("is_active")
    return plain(quality.orphans(tables.facts(spark, folder), active, "asset_key"))


@_query
def dq_domain(spark: SparkSession, folder: str) -> DataFrame:
    lake = quality.domain_violations(tables.lake(spark, folder), "lake", {"source": S.SOURCES})
    assets = quality.domain_violations(
        tables.assets(spark, folder), "dim_assets", {"asset_type": S.ASSET_TYPES}
    )
    named = dims.upsert_sources(tables.sources(spark), dims.sources_in(_all_quotes(spark, folder)))
    return lake.unionByName(assets).unionByName(quality.domain_violations(named, "dim_sources"))


# Lake


@_query
def lake_unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    return plain(lakes.unprocessed(tables.lake(spark, folder)))


@_query
def lake_parse(spark: SparkSession, folder: str) -> DataFrame:
    return plain(parse.parsed_quotes(parse.record_outcomes(tables.lake(spark, folder))))


@_query
def lake_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """All rejects; -1 stands for the whole record."""
    return parse.rejects(parse.record_outcomes(tables.lake(spark, folder))).na.fill(-1, ["element_pos"])


@_query
def lake_mark_processed(spark: SparkSession, folder: str) -> DataFrame:
    lake = tables.lake(spark, folder)
    done = parse.accepted_ids(parse.record_outcomes(lake))
    return plain(lakes.mark_processed(lake, done))


@_query
def lake_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects of records with seven different faults; -1 stands for the whole record."""
    outcomes = parse.record_outcomes(tables.faulty_lake(spark, folder))
    return parse.rejects(outcomes).na.fill(-1, ["element_pos"])


@_query
def lake_fault_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return parse.outcome_counts(parse.record_outcomes(tables.faulty_lake(spark, folder)))


@_query
def load_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return parse.outcome_counts(parse.record_outcomes(tables.lake(spark, folder)))


@_query
def load_metrics_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return parse.outcomes_by_source(parse.record_outcomes(tables.lake(spark, folder)))


# Provider payloads


@_query
def normalize_chart(spark: SparkSession, folder: str) -> DataFrame:
    return plain(feeds.quote_rows(feeds.chart_quotes(tables.chart_payloads(spark, folder))))


@_query
def normalize_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return plain(feeds.quote_rows(feeds.pair_quotes(tables.pair_payloads(spark, folder))))


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    return tables.chart_payloads(spark, folder).unionByName(tables.pair_payloads(spark, folder))


@_query
def normalize_union(spark: SparkSession, folder: str) -> DataFrame:
    return plain(feeds.quote_rows(feeds.normalize(_payloads(spark, folder))))


@_query
def quotes_to_json(spark: SparkSession, folder: str) -> DataFrame:
    normalized = feeds.chart_quotes(tables.chart_payloads(spark, folder))
    return normalized.selectExpr("payload_id", f"{feeds.quotes_to_json('quotes')} AS raw_content")


@_query
def lake_wrap(spark: SparkSession, folder: str) -> DataFrame:
    return plain(lakes.wrap(feeds.pair_quotes(tables.pair_payloads(spark, folder))))


@_query
def lake_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads normalised, wrapped as records and parsed again."""
    records = lakes.wrap(feeds.normalize(_payloads(spark, folder)))
    return plain(parse.parsed_quotes(parse.record_outcomes(records)))


@_query
def watchlist_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The quotes of the enabled sources that are on those sources' lists."""
    quotes = tables.quotes(spark, folder).select(*S.QUOTES.fieldNames())
    return plain(lakes.watched(quotes, tables.watchlist(spark, folder)))


# Pipeline


def _readable(house: Warehouse, after_load: int | None = None) -> DataFrame:
    """Facts with ticker and source name in place of the keys."""
    return (
        house.facts(after_load)
        .join(house.assets().select("asset_key", "ticker", "asset_type"), "asset_key")
        .join(house.sources().select("source_key", "source_name"), "source_key")
        .select(
            "ticker", "asset_type", "source_name", "date_key",
            "open_price", "high_price", "low_price", "close_price", "volume",
        )
    )


@_query
def lake_load(spark: SparkSession, folder: str) -> DataFrame:
    """The lake loaded into a new warehouse in two runs, read back with its dimensions."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake = tables.lake(spark, folder)
    etl.load_records(house, lake.where("is_processed"), now=NOW)
    etl.load_records(house, etl.pending(house, lake), now=NOW)
    return plain(_readable(house))


class _Dying(Warehouse):
    """A writer that dies before its commit."""

    def commit(self, row: Row, replaces: dict[str, list[str]] | None = None) -> None:
        raise OSError("died before the commit")


@_query
def load_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """A load, a second one that dies before its commit, and a third without quotes: only
    the facts of the first are there."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake = tables.lake(spark, folder)
    etl.load_records(house, lake.where("is_processed"), now=NOW)
    try:
        etl.load_records(_Dying(spark, house.root), etl.pending(house, lake), now=NOW)
    except OSError:
        etl.load_records(house, lake.where("raw_content IS NULL"), now=NOW)
    return plain(_readable(house))


@_query
def load_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads, compacted, read back with their dimensions."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake = tables.lake(spark, folder)
    for part in ("is_processed", "NOT is_processed"):
        etl.load_records(house, lake.where(part), now=NOW)
    compact(house)
    return plain(_readable(house))


@_query
def fact_load_delta(spark: SparkSession, folder: str) -> DataFrame:
    """What the second of two loads added, days of old assets included."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake = tables.lake(spark, folder)
    for part in ("is_processed", "NOT is_processed"):
        etl.load_records(house, lake.where(part), now=NOW)
    return plain(_readable(house, after_load=1).drop("asset_type"))


@_query
def lake_reingest(spark: SparkSession, folder: str) -> DataFrame:
    """Pair payloads landed with their first point alone, and again whole under the same id."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    whole, lake_path = tables.pair_payloads(spark, folder), shared_dir(spark, "lake")
    first = r"""concat(regexp_extract(payload, '^[^\\]]*\\]', 0), '],"total_volumes":[]}')"""
    for part in (whole.withColumn("payload", F.expr(first)), whole):
        etl.run_pipeline(house, part, lake_path, now=NOW)
    return plain(_readable(house))


@_query
def extract_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of which every seventh is cut short: each of these is rejected by name."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake_path = shared_dir(spark, "lake")
    cut = "CASE WHEN payload_id % 7 = 0 THEN left(payload, 20) ELSE payload END"
    etl.run_pipeline(house, _payloads(spark, folder).withColumn("payload", F.expr(cut)), lake_path, now=NOW)
    lake = spark.read.schema(S.LAKE).parquet(lake_path)
    return house.rejects().join(lake.select("record_id", "endpoint"), "record_id").select("source", "endpoint", "reason")


@_query
def etl_run_report(spark: SparkSession, folder: str) -> DataFrame:
    """Both providers' payloads through all four stages."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    return etl.run_pipeline(
        house,
        _payloads(spark, folder),
        shared_dir(spark, "lake"),
        publish_to=shared_dir(spark, "published"),
        now=NOW,
    )


@_query
def stream_load(spark: SparkSession, folder: str) -> DataFrame:
    """The lake landed as files in two steps, each picked up by the stream where it left
    off, read back with its dimensions."""
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    lake = tables.lake(spark, folder)
    for part in (lake.where("is_processed"), lake.where("not is_processed")):
        part.write.mode("append").parquet(landing)
        records = ingest.landing_stream(spark, landing)
        ingest.start_ingest(house, records, checkpoint).awaitTermination()
    return plain(_readable(house))


# Kept state


# Facts of the last source that are from 1997 on come a load late.
_LOADS = (
    "CASE WHEN date_key >= 19980101 OR date_key >= 19970101 AND source_key = 3 THEN 3 "
    "WHEN date_key >= 19970101 THEN 2 ELSE 1 END"
)
_LOAD_DAYS = (dt.date(1996, 12, 31), dt.date(1997, 12, 31), dt.date(1998, 12, 1))


@_query
def kept_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts stored in three loads; after each the state is brought up to date from that load
    alone, and summary and screener are answered from the state."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    rows = staged(tables.facts(spark, folder).withColumn("part", F.expr(_LOADS)), "kept-facts")
    assets, state, found = tables.assets(spark, folder), kept.MartState(house), []
    for load, day in enumerate(_LOAD_DAYS, start=1):
        write_facts(house, load, rows.where(f"part = {load}").drop("part"))
        house.commit(Row(load=load, dims_load=0))
        state.refresh(day)
        facts_kept = state.facts(day)
        summary = marts.portfolio_summary(facts_kept, assets, ordered=False)
        screener = marts.week52_high_low(facts_kept, assets, day, ordered=False)
        both = summary.join(screener.select("ticker", "high_52w", "low_52w", "pct_from_high", "pct_from_low"), "ticker")
        found.append(staged(both.withColumn("load", F.lit(load)), "kept-answers"))
    return plain(found[0].unionByName(found[1]).unionByName(found[2]))


@_query
def close_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Facts stored in three loads, each added to the sketches alone; per month, whether the
    quartiles and the number of different closes are within the stated errors."""
    house = Warehouse.create(spark, shared_dir(spark, "warehouse"))
    rows = staged(tables.facts(spark, folder).withColumn("part", F.expr(_LOADS)), "sketch-facts")
    store = sketches.SketchStore(house)
    for load in (1, 2, 3):
        write_facts(house, load, rows.where(f"part = {load}").drop("part"))
        house.commit(Row(load=load, dims_load=0))
        store.refresh()
    told = sketches.answers(sketches.merged(store.sketches(), "month")).withColumnRenamed("n_quotes", "n_sketched")
    # One row per month.
    held = rows.selectExpr("int(date_key div 100) AS month", "double(close_price) AS close").join(F.broadcast(told), "month")
    near = ", ".join(
        f"count_if(close < q{q}) <= count(*) * {q / 100 + sketches.RANK_ERROR} "
        f"AND count_if(close <= q{q}) >= count(*) * {q / 100 - sketches.RANK_ERROR} AS q{q}_near"
        for q in (25, 50, 75)
    )
    exact = held.groupBy("month").agg(
        F.count("*").alias("n_quotes"), F.max("n_sketched").alias("n_sketched"), F.expr(f"struct({near})").alias("near"),
        F.expr(f"abs(count(DISTINCT close) - max(n_distinct)) <= {sketches.COUNT_ERROR} * count(DISTINCT close) + 1").alias("n_distinct_near"),
    )
    return exact.select("month", "n_quotes", "n_sketched", "near.*", "n_distinct_near")


@_query
def quote_cube(spark: SparkSession, folder: str) -> DataFrame:
    return plain(cube.quote_cube(tables.facts(spark, folder), tables.assets(spark, folder)))


@_query
def sma_whole_history(spark: SparkSession, folder: str) -> DataFrame:
    """The moving average over every asset's whole history."""
    rows = tables.facts(spark, folder).selectExpr(*S.FACT_KEY, "close_price")
    return plain(series.rolling_means(rows, "asset_key", [F.col("date_key"), -F.col("source_key")], "close_price"))


@_query
def fact_pages(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_pages(tables.facts(spark, folder)).select("id", "page")


class _Overtaken(Warehouse):
    """A writer whose first commit comes too late: another one loads and commits before it."""

    def __init__(self, spark: SparkSession, root: str, at: int | None = None, other: list[DataFrame] | None = None):
        super().__init__(spark, root, at)
        self.other = other if other is not None else []

    def pinned(self) -> Warehouse:
        return type(self)(self.spark, self.root, self.last["load"], self.other)

    def commit(self, row: Row, replaces: dict[str, list[str]] | None = None) -> None:
        if self.other:
            etl.load_records(Warehouse(self.spark, self.root), self.other.pop(), now=NOW)
        super().commit(row, replaces)


@_query
def load_rebased(spark: SparkSession, folder: str) -> DataFrame:
    """Two writers at once: the second to commit starts again on top of the first."""
    root, lake = shared_dir(spark, "warehouse"), tables.lake(spark, folder)
    Warehouse.create(spark, root)
    late = _Overtaken(spark, root, other=[lake.where("is_processed")])
    etl.load_records(late, lake.where("NOT is_processed"), now=NOW)
    return plain(_readable(late))


# Joins in time


def _asof(spark: SparkSession, folder: str, **options: int) -> DataFrame:
    quoted = tables.facts(spark, folder).selectExpr(
        "asset_key", f"{key_date('date_key')} AS day", "date_key AS quote_date_key", "close_price AS quote", "-source_key AS rank"
    )
    columns = ("quote_date_key", "quote")
    return plain(asof_join(tables.asked(spark, folder), quoted, "asset_key", "day", columns, ("rank",), **options))


@_query
def asof_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with the newest quote of its part on the day it asks for or before."""
    return _asof(spark, folder)


@_query
def asof_quotes_ranged(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every part spread over ranges of time, as a hot one would be."""
    return _asof(spark, folder, hot_rows=0)


def _asset_history(spark: SparkSession, folder: str) -> DataFrame:
    history = no_rows(spark, versions.VERSIONS)
    for day, assets in tables.asset_states(spark, folder):
        history = versions.with_batch(history, assets, day)
    return staged(history, "asset-versions")


@_query
def asset_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All versions of the assets after three changes of the dimension."""
    return plain(_asset_history(spark, folder))


@_query
def facts_at_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact with the asset as it was on the fact's day."""
    quoted = tables.facts(spark, folder).selectExpr(
        *S.FACT_KEY, f"{key_date('date_key')} AS day", "close_price"
    )
    return plain(valid_at(quoted, _asset_history(spark, folder), "asset_key", "day").drop("exchange"))


# Streams of ticks


# The second step starts here; ticks of one kind come a step late.
TICKS_FROM = dt.datetime(2024, 1, 15, 6, 30)
LATE_TYPE = "error"


def _landed_ticks(spark: SparkSession, folder: str, late: bool) -> list[DataFrame]:
    rows = tables.ticks(spark, folder)
    first = F.col("ts") < F.lit(TICKS_FROM).cast(S.STAMP)
    if late:
        first = first & (F.col("event_type") != LATE_TYPE)
    return [rows.where(first), rows.where(~first)]


@_query
def stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars of a stream in two steps, the second with late ticks: finished bars, open
    ones, and late ticks by hour."""
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    store = bars.BarStore(spark, shared_dir(spark, "bars"))
    for part in _landed_ticks(spark, folder, late=True):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(part.schema).parquet(landing)
        bars.start_bars(stream, store, checkpoint).awaitTermination()
    states = {"finished": store.finished(), "open": store.still_open(), "late": bars.partial_bars(store.late())}
    told = [bars.prices(rows).withColumn("state", F.lit(state)) for state, rows in states.items()]
    return plain(told[0].unionByName(told[1]).unionByName(told[2])).withColumnsRenamed({"start": "starts", "end": "ends"})


@_query
def daily_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars put together from hourly ones."""
    hourly = bars.partial_bars(tables.ticks(spark, folder))
    return plain(bars.prices(bars.coarser(hourly))).withColumnsRenamed({"start": "starts", "end": "ends"})


@_query
def price_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Every crossing of a threshold, in one batch."""
    return _alerts(alerts.crossings(tables.ticks(spark, folder), tables.thresholds(spark, folder), idle_days=3))


def _alerts(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("ticker", "double(threshold) AS threshold", "seq", "double(price) AS price", "direction")


@_query
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream in two steps, restarted from its checkpoint in between."""
    landing, checkpoint, path = (shared_dir(spark, name) for name in ("landing", "checkpoint", "alerts"))
    wanted = tables.thresholds(spark, folder)
    with alerts.state_store(spark):
        for part in _landed_ticks(spark, folder, late=False):
            part.write.mode("append").parquet(landing)
            stream = spark.readStream.schema(part.schema).parquet(landing)
            told = alerts.alert_stream(stream, wanted, idle_days=3)
            alerts.start_alerts(told, path, checkpoint).awaitTermination()
    return _alerts(spark.read.schema(alerts.ALERTS).parquet(path))
