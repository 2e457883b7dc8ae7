"""The quotes by asset type, source and year at every level of detail.

Facts are summed once, by asset, source and year, combined map-side; what is left is joined
with the types and summed again, and only that small table is spread over the grouping sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.calendar import key_year
from quotelake.operators.bounded import broadcast_if, fits

# Volumes are summed over all facts.
_VOLUME = "CAST(sum(volume) AS DECIMAL(38,4))"


def quote_cube(facts: DataFrame, assets: DataFrame) -> DataFrame:
    """One row per combination of ``asset_type``, ``source_key`` and ``year``, and per subset of
    these. ``level`` is the grouping id: its bits (4, 2, 1) name the columns that are summed
    over and null for that reason, so a null type of an asset can be told apart."""
    measures = [
        F.expr("sum(n_quotes)").alias("n_quotes"), F.expr(_VOLUME).alias("volume"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ]
    by_asset = facts.groupBy("asset_key", "source_key", F.expr(key_year("date_key")).alias("year")).agg(
        F.count(F.lit(1)).alias("n_quotes"), F.expr(_VOLUME).alias("volume"),
        F.min("low_price").alias("low"), F.max("high_price").alias("high"),
    )
    types = broadcast_if(fits(assets), assets.select("asset_key", "asset_type"))
    by_type = by_asset.join(types, "asset_key").groupBy("asset_type", "source_key", "year").agg(*measures)
    return by_type.cube("asset_type", "source_key", "year").agg(
        F.grouping_id("asset_type", "source_key", "year").cast("int").alias("level"), *measures
    )
