from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest

from quotelake.plans import analytics, marts

TODAY = dt.date(2024, 6, 3)
DAY = dt.timedelta(days=1)


def ago(days):
    return TODAY - days * DAY


def by_ticker(rows):
    return {row.ticker: row for row in rows.collect()}


@pytest.fixture
def base(star):
    """One asset per special case."""
    return star(
        [
            (1, ago(1), 1, 152), (1, TODAY, 1, 156),
            (2, TODAY, 1, 10),                                   # a single row
            (3, ago(1), 1, 0), (3, TODAY, 1, 5),                 # previous close 0
            (4, TODAY, 1, 5),                                    # inactive
            (5, ago(400), 1, 7),                                 # nothing within a year
            (6, ago(2), 1, 8), (6, TODAY, 2, 20), (6, TODAY, 1, 10),  # two sources on the newest day
            (7, ago(90), 1, 50), (7, ago(91), 1, 40), (7, TODAY, 1, 100),
            (8, ago(365), 1, 1), (8, ago(366), 1, 900), (8, TODAY, 1, 2),
        ],
        inactive=(4,),
    )


def test_portfolio_summary(base):
    rows = by_ticker(marts.portfolio_summary(*base[:2]))
    found = {t: (r.last_close, r.previous_close, r.change_percent) for t, r in rows.items()}
    assert found == {
        "T1": (156, 152, Decimal("2.63")),
        "T2": (10, 0, 0),
        "T3": (5, 0, 0),
        "T5": (7, 0, 0),
        "T6": (10, 8, 25),
        "T7": (100, 50, 100),
        "T8": (2, 1, 100),
    }
    assert list(r.ticker for r in marts.portfolio_summary(*base[:2]).collect()) == sorted(rows)


def test_previous_row_takes_the_other_source(base):
    rows = by_ticker(marts.portfolio_summary(*base[:2], prev_by="row"))
    assert (rows["T6"].last_close, rows["T6"].previous_close, rows["T6"].change_percent) == (10, 20, -50)
    assert rows["T1"].change_percent == Decimal("2.63")


def test_daily_performance(base):
    rows = by_ticker(marts.daily_performance(*base[:2]))
    assert (rows["T1"].close_price, rows["T1"].change_percent) == (156, Decimal("2.63"))
    assert rows["T1"].asDict().keys() == {"ticker", "name", "asset_type", "close_price", "change_percent"}


def test_asset_history(base):
    rows = marts.asset_history(*base, "T1", 30).collect()
    assert [(r.date, r.close) for r in rows] == [(TODAY, 156), (ago(1), 152)]
    assert [r.close for r in marts.asset_history(*base, "T6", 2).collect()] == [10, 20]
    assert len(marts.asset_history(*base, "T7", 0).collect()) == 1
    assert marts.asset_history(*base, "T4").count() == 0
    assert marts.asset_history(*base, "nobody' OR true --").count() == 0


def test_all_histories_equal_the_single_ones(base):
    rows = marts.asset_histories(*base, days=2).collect()
    for ticker in ("T1", "T2", "T6", "T7"):
        single = marts.asset_history(*base, ticker, 2).collect()
        assert sorted(r.close for r in rows if r.ticker == ticker) == sorted(r.close for r in single)
    assert "T4" not in {r.ticker for r in rows}


def test_comparative_returns(base):
    rows = marts.comparative_returns(*base[:2], 90, TODAY).collect()
    found = [(r.ticker, r.date, r.normalized_return) for r in rows]
    assert found == sorted(found, key=lambda r: r[:2])
    by = {}
    for ticker, day, value in found:
        by.setdefault(ticker, []).append((day, value))
    assert by["T1"] == [(ago(1), 100), (TODAY, Decimal("102.63"))]
    assert by["T3"] == [(ago(1), 0), (TODAY, 0)]
    assert by["T6"] == [(ago(2), 100), (TODAY, 125), (TODAY, 250)]
    assert by["T7"] == [(ago(90), 100), (TODAY, 200)]  # the day 90 days back is inside
    assert "T4" not in by and "T5" not in by


def test_comparison_window_is_clamped(base):
    long = marts.comparative_returns(*base[:2], 100_000, TODAY)
    assert {r.date for r in long.where("ticker = 'T8'").collect()} == {TODAY, ago(365)}
    short = marts.comparative_returns(*base[:2], 1, TODAY)
    assert {r.date for r in short.where("ticker = 'T6'").collect()} == {TODAY, ago(2)}


def test_week52(base):
    rows = by_ticker(marts.week52_high_low(*base[:2], TODAY))
    found = {t: (r.last_close, r.high_52w, r.low_52w, r.pct_from_high, r.pct_from_low) for t, r in rows.items()}
    assert found["T1"] == (156, 156, 152, 0, Decimal("2.63"))
    assert found["T5"] == (7, 7, 7, 0, 0)
    assert found["T6"] == (10, 20, 8, -50, 25)
    assert found["T8"] == (2, 2, 1, 0, 100)
    assert found["T3"] == (5, 5, 0, 0, 0)
    assert "T4" not in found


def test_default_day_is_today(star):
    facts, assets, _ = star([(1, dt.date.today(), 1, 5), (1, dt.date.today() - 400 * DAY, 1, 9)])
    row = marts.week52_high_low(facts, assets).first()
    assert row.high_52w == 5
    assert marts.comparative_returns(facts, assets).count() == 1


def test_range_position(spark):
    rows = [("a", 156, 156, 152), ("b", "62.5", 100, 0), ("c", "63.5", 100, 0), ("d", 5, 5, 5), ("e", 70, 100, 0), ("f", "29.4", 100, 0)]
    frame = spark.createDataFrame(
        [(t, *(Decimal(str(x)) for x in rest), Decimal(0), Decimal(-1)) for t, *rest in rows],
        "ticker string, last_close decimal(18,8), high_52w decimal(18,8), low_52w decimal(18,8), "
        "pct_from_high decimal(18,2), pct_from_low decimal(18,2)",
    )
    rows = by_ticker(analytics.week52_position(frame))
    assert {t: (r.position, r.band) for t, r in rows.items()} == {
        "a": (100, "high"), "b": (62, "middle"), "c": (64, "middle"), "d": (50, "middle"), "e": (70, "high"), "f": (29, "low"),
    }
    assert (rows["a"].high_direction, rows["a"].low_direction) == ("up", "down")


def test_moving_average(star):
    rows = [(1, TODAY + n * DAY, 1, close) for n, close in enumerate((10, 11, 12.5, 13))]
    history = marts.asset_histories(*star(rows), days=30)
    found = analytics.asset_sma(history, 3).orderBy("date").collect()
    assert [r.sma for r in found] == [None, None, Decimal("11.17"), Decimal("12.17")]


def test_moving_average_sees_only_the_returned_rows(star):
    rows = [(1, TODAY + n * DAY, 1, n) for n in range(40)]
    found = analytics.asset_sma(marts.asset_histories(*star(rows), days=30)).orderBy("date").collect()
    assert [r.sma is None for r in found] == [True] * 19 + [False] * 11
    assert found[-1].sma == Decimal("29.50")


def test_header_falls_back(base, spark):
    wanted = spark.createDataFrame([("T1",), ("T4",), ("nobody",)], "ticker string")
    rows = by_ticker(analytics.asset_header(marts.portfolio_summary(*base[:2]), wanted))
    assert tuple(rows["T1"]) == ("T1", "Name 1", "Stock", 156, Decimal("2.63"))
    for ticker in ("T4", "nobody"):
        assert tuple(rows[ticker]) == (ticker, ticker, "", 0, 0)


def test_grid_series_and_pivot_agree(base):
    facts, assets, _ = base
    rows = marts.comparative_rows(facts, assets, 90, TODAY).collect()
    last = {}
    for row in sorted(rows, key=lambda r: r.source_key):
        last[row.ticker, row.date] = row.normalized_return
    tickers, days = {t for t, _ in last}, {d for _, d in last}
    grid = {(r.ticker, r.date): r.normalized_return for r in analytics.compare_grid(facts, assets, 90, TODAY).collect()}
    assert grid == {(t, d): last.get((t, d)) for t in tickers for d in days}
    series = {r.ticker: r.series for r in analytics.compare_series(facts, assets, 90, TODAY).collect()}
    assert {(t, d): v for t, m in series.items() for d, v in m.items()} == last
    keys = analytics.compare_series(facts, assets, 90, TODAY).selectExpr("map_keys(series) AS days").collect()
    assert all(r.days == sorted(r.days) for r in keys)
    wide = analytics.compare_pivot(facts, assets, 90, TODAY).collect()
    assert {(r.ticker, ago(n)): r[f"day_{n}"] for r in wide for n in range(91) if r[f"day_{n}"] is not None} == last
    returns = marts.comparative_returns(facts, assets, 90, TODAY)
    assert [r.ticker for r in analytics.compare_tickers(returns).collect()] == sorted(tickers)
    assert [r.date for r in analytics.compare_dates(returns).collect()] == sorted(days)


def test_display(base):
    rows = by_ticker(analytics.portfolio_display(marts.portfolio_summary(*base[:2], prev_by="row")))
    assert tuple(rows["T1"])[3:] == ("156.00", "152.00", "+2.63%", "up")
    assert rows["T6"].change_percent == "-50.00%"
    placed = analytics.week52_position(marts.week52_high_low(*base[:2], TODAY))
    shown = by_ticker(analytics.week52_display(placed))
    assert (shown["T6"].pct_from_high, shown["T6"].pct_from_low, shown["T6"].position) == ("-50.00%", "+25.00%", "17%")


def test_display_rounds_half_away_from_zero(star):
    facts, assets, dates = star([(1, TODAY, 1, "1234567.125"), (2, TODAY, 1, "0.005")])
    rows = by_ticker(analytics.history_display(marts.asset_histories(facts, assets, dates)))
    assert (rows["T1"].close, rows["T2"].close) == ("1,234,567.13", "0.01")


def test_against_brute_force(star):
    random.seed(7)
    keys = {(random.randint(1, 12), ago(random.randint(0, 500)), random.randint(1, 3)) for _ in range(600)}
    data = [(a, d, s, Decimal(random.randint(0, 40000)) / 100) for a, d, s in sorted(keys)]
    facts, assets, _ = star(data, inactive=(5,))

    def half_up(value):
        return value.quantize(Decimal("0.01"), ROUND_HALF_UP)

    def change(now, before):
        return half_up((now - before) / before * 100) if before else Decimal(0)

    summary, screener = {}, {}
    for asset in {a for a, *_ in data} - {5}:
        rows = sorted((r for r in data if r[0] == asset), key=lambda r: (-r[1].toordinal(), r[2]))
        last = rows[0][3]
        earlier = [r[3] for r in rows if r[1] < rows[0][1]]
        previous = earlier[0] if earlier else Decimal(0)
        summary[f"T{asset}"] = (last, previous, change(last, previous))
        year = [r[3] for r in rows if r[1] >= ago(365)] or None
        high, low = (max(year), min(year)) if year else (last, last)
        place = int(((last - low) / (high - low) * 100).quantize(Decimal(1), ROUND_HALF_EVEN)) if high > low else 50
        screener[f"T{asset}"] = (high, low, change(last, high) if year else 0, change(last, low) if year else 0, place)

    found = {r.ticker: tuple(r)[3:] for r in marts.portfolio_summary(facts, assets).collect()}
    assert found == summary
    placed = analytics.week52_position(marts.week52_high_low(facts, assets, TODAY)).collect()
    assert {r.ticker: (r.high_52w, r.low_52w, r.pct_from_high, r.pct_from_low, r.position) for r in placed} == screener
