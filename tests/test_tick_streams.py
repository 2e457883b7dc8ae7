"""Bars and alerts of tick streams: steps, late ticks, replays, restarts."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from quotelake.session import shared_dir
from quotelake.streaming import alerts, bars

T0 = dt.datetime(2024, 3, 1, 9, 0)


def tick(ticker, minutes, seq, price, volume=1):
    at = None if minutes is None else T0 + dt.timedelta(minutes=minutes)
    return ticker, at, seq, None if price is None else Decimal(price), Decimal(volume)


def frame(spark, ticks):
    return spark.createDataFrame(ticks, bars.TICKS)


def shown(rows):
    return sorted(
        (r["ticker"], (r["start"] - T0) // dt.timedelta(minutes=1), *(int(r[c]) for c in ("open", "high", "low", "close", "volume")), r["n_ticks"])
        for r in bars.prices(rows).collect()
    )


@pytest.fixture
def store(spark):
    return bars.BarStore(spark, shared_dir(spark, "bars"))


def test_bars_close_with_the_watermark_and_late_ticks_go_aside(spark, store):
    store.add(frame(spark, [tick("A", 5, 1, 10), tick("A", 5, 2, 12), tick("A", 50, 3, 8), tick("B", 130, 4, 7)]), 0)
    assert store.watermark() == "2024-03-01 09:10:00" and shown(store.finished()) == []
    store.add(frame(spark, [tick("A", 1, 5, 9), tick("A", 185, 6, 20, 3)]), 1)
    # 12:05 less two hours: the bar from 9 to 10 is finished, with the tick that came out of order.
    assert shown(store.finished()) == [("A", 0, 9, 12, 8, 8, 4, 4)]
    assert shown(store.still_open()) == [("A", 180, 20, 20, 20, 20, 3, 1), ("B", 120, 7, 7, 7, 7, 1, 1)]
    late, unsound = tick("A", 59, 7, 99), [tick(None, 200, 8, 1), tick("A", None, 9, 1), tick("A", 200, 10, None)]
    store.add(frame(spark, [late, *unsound, tick("A", 60, 11, 5)]), 2)
    assert shown(store.finished()) == [("A", 0, 9, 12, 8, 8, 4, 4)]
    assert sorted(r["seq"] for r in store.late().collect()) == [7, 8, 9, 10]
    assert ("A", 60, 5, 5, 5, 5, 1, 1) in shown(store.still_open())


def test_a_replayed_batch_changes_nothing_and_a_dead_one_is_not_seen(spark, store, monkeypatch):
    first, second = frame(spark, [tick("A", 5, 1, 10)]), frame(spark, [tick("A", 300, 2, 11)])
    store.add(first, 0)
    store.add(first, 0)
    assert shown(store.still_open()) == [("A", 0, 10, 10, 10, 10, 1, 1)]
    with monkeypatch.context() as dying:
        dying.setattr(bars.files, "create", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            store.add(second, 1)
    assert shown(store.finished()) == [] and shown(store.still_open()) == [("A", 0, 10, 10, 10, 10, 1, 1)]
    store.add(second, 1)
    assert shown(store.finished()) == [("A", 0, 10, 10, 10, 10, 1, 1)]
    with pytest.raises(ValueError, match="does not follow"):
        store.add(first, 5)


def test_an_empty_batch_keeps_what_is_there(spark, store):
    store.add(frame(spark, []), 0)
    assert store.watermark() is None
    store.add(frame(spark, [tick("A", 5, 1, 10)]), 1)
    store.add(frame(spark, []), 2)
    assert store.watermark() == "2024-03-01 07:05:00" and shown(store.still_open()) == [("A", 0, 10, 10, 10, 10, 1, 1)]


def test_coarser_bars_equal_bars_of_the_ticks(spark):
    rng = random.Random(2)
    ticks = frame(spark, [tick(f"T{rng.randrange(4)}", rng.randrange(6000), n, rng.randrange(100)) for n in range(800)])
    assert shown(bars.coarser(bars.partial_bars(ticks))) == shown(bars.partial_bars(ticks, bars.DAY))


def run_alerts(spark, landing, checkpoint, path, thresholds, ticks):
    frame(spark, ticks).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(bars.TICKS).parquet(landing)
    with alerts.state_store(spark):
        alerts.start_alerts(alerts.alert_stream(stream, thresholds), path, checkpoint).awaitTermination()
    return sorted((r["ticker"], int(r["threshold"]), r["seq"], r["direction"]) for r in spark.read.parquet(path).collect())


def test_alerts_once_per_crossing_also_after_a_restart(spark):
    places = [shared_dir(spark, name) for name in ("landing", "checkpoint", "alerts")]
    thresholds = spark.createDataFrame([("A", 10), ("A", 20), ("B", 5), ("B", 5), (None, 1), ("A", None)], "ticker string, threshold int")
    first = [tick("A", 0, 1, 9), tick("A", 1, 2, 10), tick("A", 2, 3, 25), tick("A", 3, 4, 25), tick("B", 0, 5, 9), tick("C", 0, 6, 1),
             tick("A", None, 7, 1), tick("A", 4, 8, None)]
    found = run_alerts(spark, *places, thresholds, first)
    assert found == [("A", 10, 2, "up"), ("A", 20, 3, "up")]
    assert run_alerts(spark, *places, thresholds, []) == found
    # Out of order, then a crossing down, then one that began before the restart.
    second = [tick("A", 2, 9, 1), tick("A", 30, 10, 15), tick("B", 40, 11, 4), tick("B", 41, 12, 5)]
    found = run_alerts(spark, *places, thresholds, second)
    assert found == sorted([("A", 10, 2, "up"), ("A", 20, 3, "up"), ("A", 20, 10, "down"), ("B", 5, 11, "down"), ("B", 5, 12, "up")])
    # More than thirty days later it is not known what happened in between.
    month = 60 * 24 * 31
    third = [tick("A", 30 + month, 13, 1), tick("A", 31 + month, 14, 50)]
    later = run_alerts(spark, *places, thresholds, third)
    assert [a for a in later if a not in found] == [("A", 10, 14, "up"), ("A", 20, 14, "up")]
    together = frame(spark, [t for t in first + second[1:] + third])
    batch = alerts.crossings(together, thresholds).collect()
    assert sorted((r["ticker"], int(r["threshold"]), r["seq"], r["direction"]) for r in batch) == later
