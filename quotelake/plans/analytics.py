"""What the pages compute on top of the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.calendar import clamp
from quotelake.functions.rates import (
    direction, grouped, position_band, range_position, signed_percent,
)
from quotelake.operators.series import SMA_ROWS, moving_average
from quotelake.plans.marts import COMPARE_DAYS, comparative_rows, compared_days


def asset_sma(histories: DataFrame, rows: int = SMA_ROWS) -> DataFrame:
    """Histories in time order with the moving average of the close.

    Takes histories of limited length, so a group is at most that long. They were cut per
    asset, and staying with that key saves an exchange.
    """
    average = moving_average("close", "asset_key", ["date", "source_key DESC"], rows)
    return histories.selectExpr("ticker", "date", "source_key", "close", f"{average} AS sma")


def asset_header(summary: DataFrame, tickers: DataFrame) -> DataFrame:
    """The headline of every requested ticker; an unknown one shows its ticker and zeros."""
    return tickers.select("ticker").distinct().join(summary, "ticker", "left").selectExpr(
        "ticker",
        "coalesce(name, ticker) AS name",
        "coalesce(asset_type, '') AS asset_type",
        "coalesce(last_close, 0) AS last_close",
        "coalesce(change_percent, 0) AS change_percent",
    )


def compare_tickers(returns: DataFrame) -> DataFrame:
    return returns.select("ticker").distinct().orderBy("ticker")


def compare_dates(returns: DataFrame) -> DataFrame:
    return returns.select("date").distinct().orderBy("date")


def _one_per_day(
    facts: DataFrame, assets: DataFrame, days: int, as_of: dt.date | None
) -> DataFrame:
    """One value per ticker and day: the one of the last source."""
    return (
        comparative_rows(facts, assets, days, as_of)
        .groupBy("ticker", "date")
        .agg(F.max_by("normalized_return", "source_key").alias("normalized_return"))
    )


def _series(daily: DataFrame) -> DataFrame:
    # One entry per day of the window: the map of a ticker is bounded by the calendar.
    pairs = "array_sort(collect_list(struct(date, normalized_return)))"
    return daily.groupBy("ticker").agg(F.expr(f"map_from_entries({pairs})").alias("series"))


def compare_series(
    facts: DataFrame, assets: DataFrame, days: int = 90, as_of: dt.date | None = None
) -> DataFrame:
    """Each ticker's returns as one date -> value map in date order."""
    return _series(_one_per_day(facts, assets, days, as_of))


def compare_grid(
    facts: DataFrame, assets: DataFrame, days: int = 90, as_of: dt.date | None = None
) -> DataFrame:
    """Every ticker on every date that any ticker has; null where it has no quote.

    The dates of the window are one small array, and every ticker's map is read at each of
    them, so no join pairs tickers with dates. The dates come from the keys alone; the
    comparison itself runs once.
    """
    daily = _one_per_day(facts, assets, days, as_of)
    dates = compared_days(facts, assets, days, as_of).agg(F.expr("array_sort(collect_list(date))")).scalar()
    return (
        _series(daily)
        .select("ticker", "series", F.explode(dates).alias("date"))
        .selectExpr("ticker", "date", "try_element_at(series, date) AS normalized_return")
    )


def compare_pivot(
    facts: DataFrame, assets: DataFrame, days: int = 90, as_of: dt.date | None = None
) -> DataFrame:
    """One row per ticker with its returns side by side, one column per day back from
    ``as_of``. The columns follow from ``days``, so tickers may be any number."""
    span = clamp(days, *COMPARE_DAYS)
    end = "current_date()" if as_of is None else f"DATE '{as_of}'"
    daily = _one_per_day(facts, assets, days, as_of).selectExpr(
        "ticker", f"date_diff({end}, date) AS day", "normalized_return"
    )
    wide = daily.groupBy("ticker").pivot("day", list(range(span + 1)))
    columns = (f"`{day}` AS day_{day}" for day in range(span + 1))
    return wide.agg(F.first("normalized_return")).selectExpr("ticker", *columns)


def week52_position(week52: DataFrame) -> DataFrame:
    """The screener with the place of the last close between low and high."""
    position = range_position("last_close", "low_52w", "high_52w")
    return week52.selectExpr("*", f"{position} AS position").selectExpr(
        "*",
        f"{position_band('position')} AS band",
        f"{direction('pct_from_high')} AS high_direction",
        f"{direction('pct_from_low')} AS low_direction",
    )


def portfolio_display(summary: DataFrame) -> DataFrame:
    """The summary as the dashboard prints it."""
    return summary.selectExpr(
        "ticker", "name", "asset_type",
        f"{grouped('last_close')} AS last_close",
        f"{grouped('previous_close')} AS previous_close",
        f"{signed_percent('change_percent')} AS change_percent",
        f"{direction('change_percent')} AS direction",
    )


def week52_display(positions: DataFrame) -> DataFrame:
    """The screener as its page prints it; the distance from the low always has a plus."""
    return positions.selectExpr(
        "ticker", "name", "asset_type",
        *(f"{grouped(name)} AS {name}" for name in ("last_close", "high_52w", "low_52w")),
        f"{signed_percent('pct_from_high')} AS pct_from_high",
        f"concat('+', {grouped('pct_from_low')}, '%') AS pct_from_low",
        "concat(position, '%') AS position",
        "band",
    )


def history_display(histories: DataFrame) -> DataFrame:
    """Histories as the asset page prints them."""
    return histories.selectExpr(
        "ticker", "source_key", "string(date) AS date",
        *(f"{grouped(name)} AS {name}" for name in ("open", "high", "low", "close")),
        f"{grouped('volume', 0)} AS volume",
    )
