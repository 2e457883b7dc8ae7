"""Dimension reads and set-level upserts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from quotelake import schemas as S
from quotelake.functions.calendar import calendar_columns, date_key, stamp
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.operators.dedup import first_wins
from quotelake.operators.keys import number_after

ASSET_FIELDS = ("name", "asset_type", "exchange", "is_active")
SOURCE_FIELDS = ("base_url", "is_active")
# Rows of a dimension whose keys are broadcast at most. A row takes about 140 bytes, which the
# driver holds several times while it builds and sends the broadcast.
MAX_LOOKUP_ROWS = 100_000


def active_assets(assets: DataFrame) -> DataFrame:
    return assets.where("is_active").orderBy("ticker")


def lookup(dim: DataFrame, natural_key: str, wanted: DataFrame) -> DataFrame:
    """The dimension row of every wanted key; nulls where the dimension has none."""
    return wanted.select(natural_key).distinct().join(dim, natural_key, "left")


def asset_type_of(source: str, overrides: dict[str, str] | None = None) -> str:
    """The asset type a source stands for."""
    rule = {**S.ASSET_TYPE_BY_SOURCE, **(overrides or {})}
    cases = " ".join(f"WHEN '{name}' THEN '{kind}'" for name, kind in rule.items())
    return f"CASE {source} {cases} ELSE '{S.DEFAULT_ASSET_TYPE}' END"


def assets_in(quotes: DataFrame, order: Sequence[str] = S.BATCH_ORDER) -> DataFrame:
    """The asset each ticker of a batch asks for; its first quote decides the type."""
    first = first_wins(quotes.select("ticker", "source", *order), ["ticker"], order)
    return first.selectExpr(
        "ticker",
        "ticker AS name",
        f"{asset_type_of('source')} AS asset_type",
        "CAST(NULL AS STRING) AS exchange",
        "true AS is_active",
    )


def sources_in(quotes: DataFrame) -> DataFrame:
    return quotes.select("source").distinct().selectExpr(
        "source AS source_name", "'' AS base_url", "true AS is_active"
    )


def _split(
    stored: DataFrame, incoming: DataFrame, natural_key: str, key: str, fields: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Stored rows with the batch's fields where it has the key (``changed``), and the rows
    of new keys with their numbers."""
    batch = incoming.selectExpr(natural_key, f"struct({', '.join(fields)}) AS new")
    merged = stored.join(batch, natural_key, "left").selectExpr(
        *(name for name in stored.columns if name not in fields),
        *(f"CASE WHEN new IS NULL THEN {name} ELSE new.{name} END AS {name}" for name in fields),
        "new IS NOT NULL AS changed",
    )
    fresh = incoming.join(stored.select(natural_key), natural_key, "left_anti")
    return merged, number_after(fresh, stored, natural_key, key)


def upsert_assets(
    stored: DataFrame, incoming: DataFrame, now: dt.datetime | None = None
) -> DataFrame:
    """The asset dimension after the batch: known tickers keep key and creation time and
    take the new attributes, new tickers get the next keys, the rest stays."""
    merged, fresh = _split(stored, incoming, "ticker", "asset_key", ASSET_FIELDS)
    at = stamp(now)
    kept = merged.selectExpr(
        "asset_key", "ticker", *ASSET_FIELDS, "created_at",
        f"CASE WHEN changed THEN {at} ELSE updated_at END AS updated_at",
    )
    return kept.unionAll(
        fresh.selectExpr("asset_key", "ticker", *ASSET_FIELDS, f"{at} AS created_at", f"{at} AS updated_at")
    )


def upsert_sources(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The source dimension after the batch, by name, as for the assets."""
    merged, fresh = _split(stored, incoming, "source_name", "source_key", SOURCE_FIELDS)
    columns = ("source_key", "source_name", *SOURCE_FIELDS)
    return merged.select(*columns).unionAll(fresh.select(*columns))


def missing_dates(stored: DataFrame, days: DataFrame, column: str = "date") -> DataFrame:
    """Date rows the batch needs and the dimension does not have yet."""
    wanted = days.select(column).distinct().selectExpr(*calendar_columns(column))
    return wanted.join(stored.select("date_key"), "date_key", "left_anti")


def with_keys(quotes: DataFrame, assets: DataFrame, sources: DataFrame) -> DataFrame:
    """Quotes with their three keys; the date key is a function of the date."""
    asset_keys = broadcast_if(fits(assets, MAX_LOOKUP_ROWS), assets.select("ticker", "asset_key"))
    source_keys = broadcast_if(fits(sources, MAX_LOOKUP_ROWS), sources.selectExpr("source_name AS source", "source_key"))
    return (
        quotes.join(asset_keys, "ticker")
        .join(source_keys, "source")
        .selectExpr("*", f"{date_key('date')} AS date_key")
    )
