"""Price alerts: a quote stream that tells when a price crosses a threshold, once per crossing.

A ticker's price is above a threshold or below it; equal counts as above. An alert is told when
a quote lies on the other side than the quote before it. The first quote of a ticker only says
on which side it is, and so does the first one after ``idle`` without quotes: what happened in
between is not known. Thresholds are rows of ``ticker`` and ``threshold``; a ticker may have
several, each with alerts of its own.

In a stream the side lives in the state of its (ticker, threshold), so a restart from the
checkpoint neither repeats nor loses an alert. A timer drops the state of a ticker that has
been idle. Within a batch quotes are taken in order of time and ``seq``; one that is not after
the last quote seen is out of order and tells nothing. ``crossings`` is the same in a batch,
with windows.

Nulls: quotes without ticker, time or price, and thresholds without ticker or value, are left
out. Repeated quotes are on one side and tell nothing new.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quotelake.operators.bounded import broadcast_if, fits

IDLE_DAYS = 30
ALERTS = "ticker string, threshold decimal(18,8), ts timestamp_ntz, seq bigint, price decimal(18,8), direction string"
# The state store that keyed processors need.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Starts queries inside it on the state store that keyed processors need, and puts the
    session's own setting back."""
    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def watched_quotes(quotes: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every quote with each threshold of its ticker and the side it is on."""
    wanted = thresholds.where("ticker IS NOT NULL AND threshold IS NOT NULL").selectExpr(
        "ticker", "CAST(threshold AS DECIMAL(18,8)) AS threshold"
    ).distinct()
    sound = quotes.where("ticker IS NOT NULL AND ts IS NOT NULL AND price IS NOT NULL").selectExpr(
        "ticker", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "coalesce(bigint(seq), -1L) AS seq", "CAST(price AS DECIMAL(18,8)) AS price"
    )
    return sound.join(broadcast_if(fits(wanted), wanted), "ticker").withColumn("above", F.expr("price >= threshold"))


def crossings(quotes: DataFrame, thresholds: DataFrame, idle_days: int = IDLE_DAYS) -> DataFrame:
    """The alerts of all quotes at once."""
    before = "OVER (PARTITION BY ticker, threshold ORDER BY ts, seq, price)"
    told = watched_quotes(quotes, thresholds).selectExpr(
        "*", f"lag(above) {before} AS above_before", f"lag(ts) {before} AS ts_before"
    )
    return told.where(f"above <> above_before AND ts - ts_before <= INTERVAL '{idle_days}' DAY").selectExpr(
        "ticker", "threshold", "ts", "seq", "price", "IF(above, 'up', 'down') AS direction"
    )


class Crossing(StatefulProcessor):
    """The side of one ticker and threshold; see the module."""

    def __init__(self, idle_days: int = IDLE_DAYS):
        self.idle = dt.timedelta(days=idle_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("side", "above boolean, micros bigint, seq bigint, price decimal(18,8), timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803 (names of the interface)
        held = self.state.get() if self.state.exists() else None
        above, last, timer = (held[0], (held[1], held[2], held[3]), held[4]) if held else (None, None, None)
        idle = self.idle // dt.timedelta(microseconds=1)
        for row in sorted(rows, key=lambda r: (r["micros"], r["seq"], r["price"])):
            place = (row["micros"], row["seq"], row["price"])
            if last is not None and place <= last:
                continue
            known = last is not None and row["micros"] - last[0] <= idle
            if known and row["above"] != above:
                yield Row(
                    ticker=key[0], threshold=key[1], micros=row["micros"], seq=row["seq"], price=row["price"],
                    direction="up" if row["above"] else "down",
                )
            above, last = row["above"], place
        if last is None:
            return
        due = (last[0] + idle) // 1000 + 1
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.state.update((above, *last, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def alert_stream(quotes: DataFrame, thresholds: DataFrame, delay: str = "1 hour", idle_days: int = IDLE_DAYS) -> DataFrame:
    """The alerts of a stream of quotes. ``delay`` bounds how late a quote may come."""
    watched = watched_quotes(quotes, thresholds).selectExpr(
        "ticker", "threshold", "seq", "price", "above", "unix_micros(CAST(ts AS TIMESTAMP)) AS micros", "CAST(ts AS TIMESTAMP) AS at"
    )
    out = "ticker string, threshold decimal(18,8), micros bigint, seq bigint, price decimal(18,8), direction string"
    told = watched.withWatermark("at", delay).groupBy("ticker", "threshold").transformWithState(
        Crossing(idle_days), out, "Append", "EventTime"
    )
    return told.selectExpr(
        "ticker", "threshold", "CAST(timestamp_micros(micros) AS TIMESTAMP_NTZ) AS ts", "seq", "price", "direction"
    )


def start_alerts(alerts: DataFrame, path: str, checkpoint: str, every_minutes: int | None = None) -> StreamingQuery:
    """Appends alerts to a Parquet folder, each once; without an interval, what is there, then ends."""
    writer = alerts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if every_minutes is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_minutes} minutes").start()
