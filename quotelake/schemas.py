"""Table schemas, decimal types and allowed values.

Every stamp is a UTC wall-clock value held as TIMESTAMP_NTZ, so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
VOLUME = T.DecimalType(18, 4)
STAMP = T.TimestampNTZType()

# Provider names, asset types and the provider -> asset type rule.
YAHOO = "YahooFinance"
COINGECKO = "CoinGecko"
SOURCES = (YAHOO, COINGECKO)
ASSET_TYPES = ("Stock", "ETF", "Crypto")
DEFAULT_ASSET_TYPE = "Stock"
ASSET_TYPE_BY_SOURCE = {YAHOO: "Stock", COINGECKO: "Crypto"}

# Longest text each column may hold.
MAX_LENGTH = {
    "lake": {"source": 50, "endpoint": 256},
    "dim_assets": {"ticker": 20, "name": 200, "asset_type": 20, "exchange": 50},
    "dim_sources": {"source_name": 50, "base_url": 256},
}

# Columns that must be present.
REQUIRED = {
    "lake": ("source", "endpoint", "raw_content", "loaded_at", "is_processed"),
    "dim_assets": ("ticker", "name", "asset_type", "is_active", "created_at", "updated_at"),
    "dim_sources": ("source_name", "base_url", "is_active"),
}


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LAKE = _schema(
    ("record_id", T.LongType()),
    ("source", T.StringType()),
    ("endpoint", T.StringType()),
    ("raw_content", T.StringType()),
    ("loaded_at", STAMP),
    ("is_processed", T.BooleanType()),
)

QUOTES = _schema(
    ("ticker", T.StringType()),
    ("date", T.DateType()),
    ("open", PRICE),
    ("high", PRICE),
    ("low", PRICE),
    ("close", PRICE),
    ("volume", VOLUME),
    ("source", T.StringType()),
    ("loaded_at", STAMP),
    ("record_id", T.LongType()),
    ("element_pos", T.IntegerType()),
)

# The order in which quotes reached the lake; decides which duplicate is "first".
BATCH_ORDER = ("loaded_at", "record_id", "element_pos")

DIM_ASSETS = _schema(
    ("asset_key", T.IntegerType()),
    ("ticker", T.StringType()),
    ("name", T.StringType()),
    ("asset_type", T.StringType()),
    ("exchange", T.StringType()),
    ("is_active", T.BooleanType()),
    ("created_at", STAMP),
    ("updated_at", STAMP),
)

DIM_DATES = _schema(
    ("date_key", T.IntegerType()),
    ("full_date", T.DateType()),
    ("year", T.IntegerType()),
    ("quarter", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("week_of_year", T.IntegerType()),
    ("is_weekend", T.BooleanType()),
)

DIM_SOURCES = _schema(
    ("source_key", T.IntegerType()),
    ("source_name", T.StringType()),
    ("base_url", T.StringType()),
    ("is_active", T.BooleanType()),
)

FACT_QUOTES = _schema(
    ("id", T.LongType()),
    ("asset_key", T.IntegerType()),
    ("date_key", T.IntegerType()),
    ("source_key", T.IntegerType()),
    ("open_price", PRICE),
    ("high_price", PRICE),
    ("low_price", PRICE),
    ("close_price", PRICE),
    ("volume", VOLUME),
    ("loaded_at", STAMP),
)

FACT_KEY = ("asset_key", "date_key", "source_key")
