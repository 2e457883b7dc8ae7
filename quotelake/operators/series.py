"""Per-asset time series: the latest rows and the moving average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.keys import recency
from quotelake.operators.numbering import numbered

SMA_ROWS = 20
# Rows of a block of the rolling mean.
BLOCK_ROWS = 100_000


def latest_close(facts: DataFrame) -> DataFrame:
    """The newest close of each asset, by a hash aggregate combined before the exchange."""
    return facts.groupBy("asset_key").agg(
        F.expr(f"max_by(close_price, {recency()})").alias("last_close"),
        F.max("date_key").alias("date_key"),
    )


def last_two_days(facts: DataFrame) -> DataFrame:
    """The close of each asset's newest day and of the day before it, null if none.

    A day with several sources is read from the lowest source key. Only the rows of an
    asset's two newest days leave a task, so a long history costs the exchange nothing.
    """
    by_day = "dense_rank() OVER (PARTITION BY asset_key ORDER BY date_key DESC)"
    recent = facts.selectExpr("asset_key", "source_key", "close_price", f"{by_day} AS day")
    return recent.where("day <= 2").groupBy("asset_key").agg(
        F.expr("min_by(close_price, CASE WHEN day = 1 THEN source_key END)").alias("last_close"),
        F.expr("min_by(close_price, CASE WHEN day = 2 THEN source_key END)").alias("previous_close"),
    )


def last_two_rows(facts: DataFrame) -> DataFrame:
    """As ``last_two_days`` but by row: the second source of the newest day counts as previous."""
    by_row = "row_number() OVER (PARTITION BY asset_key ORDER BY date_key DESC, source_key)"
    recent = facts.selectExpr("asset_key", "close_price", f"{by_row} AS nth")
    return recent.where("nth <= 2").groupBy("asset_key").agg(
        F.expr("max(close_price) FILTER (WHERE nth = 1)").alias("last_close"),
        F.expr("max(close_price) FILTER (WHERE nth = 2)").alias("previous_close"),
    )


def moving_average(value: str, by: str, order: Sequence[str], rows: int = SMA_ROWS) -> str:
    """Mean of the last ``rows`` values, floor(x * 100 + 0.5) / 100; null until there are that many.

    The mean is taken from an exact decimal sum. Give it groups of bounded length.
    """
    window = (
        f"OVER (PARTITION BY {by} ORDER BY {', '.join(order)} "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )
    cents = f"floor(sum({value}) {window} * 100 / {rows} + 0.5)"
    return f"CASE WHEN count(*) {window} = {rows} THEN CAST({cents} / 100 AS DECIMAL(18,2)) END"


def rolling_means(
    rows: DataFrame, key: str, order: Sequence[Column], value: str, rows_in: int = SMA_ROWS, block: int = BLOCK_ROWS
) -> DataFrame:
    """``rows`` with ``sma``, as ``moving_average``, for keys with any number of rows.

    All rows are numbered by key and ``order`` and cut into blocks of ``block``, whatever their
    keys, so a key with a third of all rows is many blocks. The last ``rows_in - 1`` rows of a
    block go to the next one as well (the halo), where they are only looked back at. ``order``
    must make a key's rows distinct; ``rows`` must have no column ``sma``.
    """
    halo = rows_in - 1
    if block < halo:
        raise ValueError(f"a block of {block} rows is shorter than its halo of {halo}")
    held = rows.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{value}`").alias("v"), *(by.alias(f"o{n}") for n, by in enumerate(order)),
        F.struct(*(F.col(f"`{name}`") for name in rows.columns)).alias("held"),
    )
    placed = numbered(held, [F.asc("k"), *(F.asc(f"o{n}") for n in range(len(order)))], "n").selectExpr(
        "k", "v", "held", "n", f"n div {block} AS own",
        f"explode(IF(n % {block} >= {block - halo}, array(n div {block}, n div {block} + 1), array(n div {block}))) AS block",
    )
    mean = moving_average("v", "block, k", ["n"], rows_in)
    return placed.selectExpr("held", "own", "block", f"{mean} AS sma").where("own = block").select("held.*", "sma")
