"""Version history of the asset dimension (slowly changing, type 2).

An upsert of the dimension overwrites attributes. The history keeps every state of an asset
with the days it was valid: ``valid_from <= day < valid_to``, null for the present one. The
first version of an asset is valid from the beginning of time, so a fact older than its asset
meets a version too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quotelake import schemas as S
from quotelake.operators.dims import ASSET_FIELDS

BEGINNING = dt.date(1, 1, 1)

VERSIONS = T.StructType(
    [
        *(S.DIM_ASSETS[name] for name in ("asset_key", "ticker", *ASSET_FIELDS)),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
    ]
)


def with_batch(history: DataFrame, assets: DataFrame, day: dt.date) -> DataFrame:
    """The history after the dimension became ``assets`` on ``day``.

    An asset whose attributes changed gets a new version and its open one ends on ``day``; an
    asset that is new gets its first one; an asset that is gone from the dimension keeps its
    open version. A change on the day on which the open version began replaces that version.
    Assets must not repeat. Days must not go back: a batch older than an open version fails.
    """
    names = ", ".join(ASSET_FIELDS)
    fresh = assets.selectExpr("asset_key", "ticker AS new_ticker", f"struct({names}) AS new")
    opened = history.where("valid_to IS NULL").selectExpr("*", f"struct({names}) AS old")
    met = opened.join(fresh, "asset_key", "full_outer")
    on = f"DATE '{day:%Y-%m-%d}'"
    changed = "old IS NOT NULL AND new IS NOT NULL AND NOT (old <=> new)"
    states = met.selectExpr(
        "*",
        f"CASE WHEN old IS NULL THEN 'first' WHEN NOT ({changed}) THEN 'same' WHEN valid_from > {on} "
        f"THEN raise_error('the history has a later version') WHEN valid_from = {on} THEN 'replaced' ELSE 'ended' END AS state",
    )
    old = "struct(asset_key, ticker, {fields}, valid_from, {end} AS valid_to)"
    kept = old.format(fields=", ".join(f"old.{n} AS {n}" for n in ASSET_FIELDS), end="CAST(NULL AS DATE)")
    ended = old.format(fields=", ".join(f"old.{n} AS {n}" for n in ASSET_FIELDS), end=on)
    new = (
        f"struct(asset_key, new_ticker AS ticker, {', '.join(f'new.{n} AS {n}' for n in ASSET_FIELDS)}, "
        "{start} AS valid_from, CAST(NULL AS DATE) AS valid_to)"
    )
    rows = (
        f"CASE state WHEN 'same' THEN array({kept}) WHEN 'first' THEN array({new.format(start=_literal(BEGINNING))}) "
        f"WHEN 'replaced' THEN array({new.format(start='valid_from')}) ELSE array({ended}, {new.format(start=on)}) END"
    )
    live = states.selectExpr(f"inline({rows})")
    return history.where("valid_to IS NOT NULL").select(*VERSIONS.fieldNames()).unionByName(live.select(*VERSIONS.fieldNames()))


def _literal(day: dt.date) -> str:
    return f"DATE '{day.year:04d}-{day.month:02d}-{day.day:02d}'"
