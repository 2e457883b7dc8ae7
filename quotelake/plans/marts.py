"""The five mart queries.

They take the fact and the asset dimension and return the rows a user sees. Rows carry
exact decimals. ``ordered=False`` leaves out the final sort when another step follows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.calendar import clamp, date_key, key_date, look_back
from quotelake.functions.rates import normalized_return, percent_change
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.operators.dedup import first_rows
from quotelake.operators.keys import earliness, recency
from quotelake.operators.series import last_two_days, last_two_rows

YEAR_DAYS = 365
HISTORY_DAYS = (1, 365)
COMPARE_DAYS = (7, 365)


def _labels(assets: DataFrame) -> DataFrame:
    return assets.where("is_active").select("asset_key", "ticker", "name", "asset_type")


def _since(facts: DataFrame, as_of: dt.date | None, days: int) -> DataFrame:
    """Facts from the look-back day on. The test is on the fact's own date key, and on the
    year where the fact is stored by year, so files outside the window are not opened."""
    first = look_back(as_of, days)
    rows = facts.where(f"date_key >= {date_key(first)}")
    return rows.where(f"year >= year({first})") if "year" in facts.columns else rows


def _sorted(rows: DataFrame, ordered: bool, *by: str) -> DataFrame:
    return rows.orderBy(*by) if ordered else rows


def portfolio_summary(
    facts: DataFrame, assets: DataFrame, prev_by: str = "date", ordered: bool = True
) -> DataFrame:
    """Last and previous close of every active asset and the change in percent.

    ``prev_by="date"`` compares with the day before, ``"row"`` with the row before.
    """
    closes = {"date": last_two_days, "row": last_two_rows}[prev_by](facts)
    rows = closes.join(_labels(assets), "asset_key").selectExpr(
        "ticker",
        "name",
        "asset_type",
        "last_close",
        "coalesce(previous_close, 0) AS previous_close",
        f"{percent_change('last_close', 'previous_close')} AS change_percent",
    )
    return _sorted(rows, ordered, "ticker")


def daily_performance(
    facts: DataFrame, assets: DataFrame, prev_by: str = "date", ordered: bool = True
) -> DataFrame:
    """Close of every active asset and its change against the previous day."""
    return portfolio_summary(facts, assets, prev_by, ordered).selectExpr(
        "ticker", "name", "asset_type", "last_close AS close_price", "change_percent"
    )


def asset_history_view(facts: DataFrame, assets: DataFrame, dates: DataFrame) -> DataFrame:
    """Every quote of the active assets with its ticker and date: the star join."""
    labels = broadcast_if(fits(assets), _labels(assets).select("asset_key", "ticker"))
    # Days come from payload text, so their number is checked like any other.
    days = broadcast_if(fits(dates), dates.select("date_key", "full_date"))
    return facts.join(labels, "asset_key").join(days, "date_key").selectExpr(
        "asset_key",
        "ticker",
        "full_date AS date",
        "open_price AS open",
        "high_price AS high",
        "low_price AS low",
        "close_price AS close",
        "volume",
        "source_key",
    )


def asset_history(
    facts: DataFrame, assets: DataFrame, dates: DataFrame, ticker: str, days: int = 30
) -> DataFrame:
    """The newest ``days`` rows of one asset, newest first."""
    return (
        asset_history_view(facts, assets.where(F.col("ticker") == ticker), dates)
        .orderBy(F.desc("date"), "source_key")
        .limit(clamp(days, *HISTORY_DAYS))
        .drop("source_key", "asset_key", "ticker")
    )


def asset_histories(
    facts: DataFrame, assets: DataFrame, dates: DataFrame, days: int = 30
) -> DataFrame:
    """``asset_history`` of all active assets at once. The rows are cut per asset before
    the joins, so only rows of the result are exchanged and labelled."""
    newest = first_rows(
        facts, ["asset_key"], ["date_key DESC", "source_key"], clamp(days, *HISTORY_DAYS)
    )
    return asset_history_view(newest, assets, dates)


def comparative_rows(
    facts: DataFrame, assets: DataFrame, days: int = 90, as_of: dt.date | None = None
) -> DataFrame:
    """``comparative_returns`` unsorted and with the source key.

    The base price comes from a hash aggregate and is joined back. The quotes themselves
    are not exchanged while the base prices, at most one per asset, fit a broadcast.
    """
    in_range = _since(facts, as_of, clamp(days, *COMPARE_DAYS)).select(
        "asset_key", "date_key", "source_key", "close_price"
    )
    bases = (
        in_range.groupBy("asset_key")
        .agg(F.expr(f"min_by(close_price, {earliness()})").alias("base"))
        .join(_labels(assets).select("asset_key", "ticker"), "asset_key")
    )
    return in_range.join(broadcast_if(fits(assets), bases), "asset_key").selectExpr(
        "ticker",
        f"{key_date('date_key')} AS date",
        "close_price AS close",
        f"{normalized_return('close_price', 'base')} AS normalized_return",
        "source_key",
    )


def compared_days(
    facts: DataFrame, assets: DataFrame, days: int = 90, as_of: dt.date | None = None
) -> DataFrame:
    """The dates on which any active asset has a quote in the window."""
    active = assets.where("is_active").select("asset_key")
    in_range = _since(facts, as_of, clamp(days, *COMPARE_DAYS)).select("asset_key", "date_key")
    wanted = in_range.join(broadcast_if(fits(assets), active), "asset_key", "left_semi")
    return wanted.select("date_key").distinct().selectExpr(f"{key_date('date_key')} AS date")


def comparative_returns(
    facts: DataFrame,
    assets: DataFrame,
    days: int = 90,
    as_of: dt.date | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Close of every active asset and day in the window, as percent of its first close there."""
    rows = comparative_rows(facts, assets, days, as_of)
    return _sorted(rows, ordered, "ticker", "date", "source_key").drop("source_key")


def week52_high_low(
    facts: DataFrame, assets: DataFrame, as_of: dt.date | None = None, ordered: bool = True
) -> DataFrame:
    """Newest close of every active asset against its highest and lowest close of a year.

    Newest close and both extremes come from one pass and one small exchange. An asset
    without a quote in the year shows its last close and 0 percent.
    """
    recent = f"FILTER (WHERE date_key >= {date_key(look_back(as_of, YEAR_DAYS))})"
    closes = facts.groupBy("asset_key").agg(
        F.expr(f"max_by(close_price, {recency()})").alias("last_close"),
        F.expr(f"max(close_price) {recent}").alias("high"),
        F.expr(f"min(close_price) {recent}").alias("low"),
    )
    rows = closes.join(_labels(assets), "asset_key").selectExpr(
        "ticker",
        "name",
        "asset_type",
        "last_close",
        "coalesce(high, last_close) AS high_52w",
        "coalesce(low, last_close) AS low_52w",
        f"{percent_change('last_close', 'high')} AS pct_from_high",
        f"{percent_change('last_close', 'low')} AS pct_from_low",
    )
    return _sorted(rows, ordered, "ticker")
