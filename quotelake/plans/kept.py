"""Mart state kept beside the facts and brought up to date from new loads only.

Daily performance, portfolio summary and the 52-week screener need little of an asset's
history: its two newest days, and the days of the last year whose close no later day has
reached from above or from below. Facts are only ever added, so a day that is neither can
never matter again, and both kinds merge with new facts in any order, late ones included.

The state is a table of such days in hash buckets of the asset. A refresh reads the facts
that later loads added and the buckets they touch, writes these buckets anew and, last of
all, a manifest that names each bucket's folder. A dead refresh is never seen; of two that
start from one state the second starts again on top of the first. A reader gets the rows as a small fact
that the mart queries take in place of the whole one.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import schemas as S
from quotelake.operators.keys import SOURCE_BITS
from quotelake.plans.marts import YEAR_DAYS
from quotelake.session import staged
from quotelake.sources import files
from quotelake.sources.warehouse import Warehouse, no_rows

BUCKETS = 64
# Extremes carry a source key above all real ones, so they are never the close of a day.
_EXTREME = 1 << SOURCE_BITS

DAYS = T.StructType(
    [
        *(T.StructField(name, T.IntegerType()) for name in ("asset_key", "date_key", "source_key")),
        *(T.StructField(name, S.PRICE) for name in ("close_price", "high_close", "low_close")),
    ]
)


def days_of(facts: DataFrame) -> DataFrame:
    """One row per asset and day: the close of the lowest source, highest and lowest close."""
    return _by_day(facts.selectExpr(*S.FACT_KEY, "close_price", "close_price AS high_close", "close_price AS low_close"))


def _by_day(days: DataFrame) -> DataFrame:
    return days.groupBy("asset_key", "date_key").agg(
        F.min("source_key").alias("source_key"),
        F.min_by("close_price", "source_key").alias("close_price"),
        F.max("high_close").alias("high_close"),
        F.min("low_close").alias("low_close"),
    )


def merged(one: DataFrame, other: DataFrame, since: int) -> DataFrame:
    """The days to keep of two sets of days; extremes before the date key ``since`` have expired."""
    later = "OVER (PARTITION BY asset_key ORDER BY date_key DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ranked = _by_day(one.unionByName(other)).selectExpr(
        "*",
        "row_number() OVER (PARTITION BY asset_key ORDER BY date_key DESC) AS nth",
        f"max(high_close) {later} AS above",
        f"min(low_close) {later} AS below",
    )
    wanted = f"nth <= 2 OR date_key >= {since} AND (high_close > above OR low_close < below)"
    return ranked.where(wanted).select(*DAYS.fieldNames())


def _key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def unknown(house: Warehouse, state: dict | None) -> DataFrame:
    """The facts a state does not know yet: only the folders of later loads are opened."""
    return house.facts(after_load=state["load"] if state else 0)


class MartState:
    """The kept state of a warehouse's marts."""

    def __init__(self, house: Warehouse, buckets: int = BUCKETS):
        self.house, self.spark, self.buckets = house, house.spark, buckets
        self.root = f"{house.root}/mart_state"
        self._known = -1

    def manifest(self) -> dict | None:
        version = files.newest(self.spark, f"{self.root}/manifest", self._known)
        if version < 0:
            return None
        self._known = version
        return json.loads(files.text(self.spark, files.numbered(f"{self.root}/manifest", version)))

    def refresh(self, as_of: dt.date) -> dict:
        """Brings the state up to the newest commit; returns its manifest. ``as_of`` is the
        earliest day that will be asked for from now on."""
        spark, base = self.spark, self.house.pinned()
        load, before = base.last["load"], self.manifest()
        if before and before["load"] >= load:
            return before
        first = _key(as_of - dt.timedelta(days=YEAR_DAYS))
        since = max(first, before["since"]) if before else first
        bucket = f"int(pmod(xxhash64(asset_key), {self.buckets}))"
        fresh = staged(days_of(unknown(base, before)), "mart-delta")
        touched = [row[0] for row in fresh.selectExpr(f"{bucket} AS bucket").distinct().collect()]
        known = before["buckets"] if before else {}
        stored = self._days({b: folder for b, folder in known.items() if int(b) in touched})
        folder = f"part={load:010d}-{uuid.uuid4().hex}"
        rows = merged(stored, fresh, since).withColumn("bucket", F.expr(bucket))
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/days/{folder}")
        # Merging never empties a bucket, so every touched one has been written.
        held = {
            "version": before["version"] + 1 if before else 0, "load": load, "since": since,
            "buckets": known | {str(b): folder for b in touched},
        }
        if files.create(spark, files.numbered(f"{self.root}/manifest", held["version"]), json.dumps(held)):
            return held
        # Another refresh came first; what it has not seen is added on top of it.
        return self.refresh(as_of)

    def _days(self, buckets: dict[str, str]) -> DataFrame:
        if not buckets:
            return no_rows(self.spark, DAYS)
        parts = [f"{folder}/bucket={bucket}" for bucket, folder in sorted(buckets.items())]
        return files.read_parts(self.spark, DAYS, f"{self.root}/days", parts)

    def facts(self, as_of: dt.date) -> DataFrame:
        """The kept days as facts for the marts by day (``prev_by="date"``) of ``as_of`` or a
        later day. One row has the day's close, two more the day's extremes."""
        held = self.manifest()
        if held is None:
            raise ValueError(f"no mart state at {self.root}")
        if _key(as_of - dt.timedelta(days=YEAR_DAYS)) < held["since"]:
            raise ValueError(f"the mart state keeps extremes from {held['since']} on; {as_of} needs earlier ones")
        closes = (
            f"array(struct(source_key AS s, close_price AS c), struct({_EXTREME} AS s, high_close AS c), "
            f"struct({_EXTREME} AS s, low_close AS c))"
        )
        return self._days(held["buckets"]).selectExpr(
            "asset_key", "date_key", f"inline({closes}) AS (source_key, close_price)"
        )
