"""Surrogate keys without a global sort or counter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.calendar import day_number

# Hex digits of the bucket hash: 16 ** 3 = 4096 buckets.
BUCKET_DIGITS = 3

# Fact id layout: asset key (31 bits), day number (22 bits), source key (10 bits).
DAY_BITS = 22
SOURCE_BITS = 10


def fact_id(asset_key: str, date_key: str, source_key: str) -> str:
    """A 63-bit id that is different for different keys and sorts as they do.

    The parts are packed, not hashed, so no number of facts can collide. A source key that
    does not fit its bits fails the query instead of running into the day.
    """
    fits = f"{source_key} BETWEEN 0 AND {(1 << SOURCE_BITS) - 1}"
    source = f"CASE WHEN {source_key} IS NULL OR {fits} THEN bigint({source_key}) ELSE raise_error('source key above {(1 << SOURCE_BITS) - 1}') END"
    return (
        f"(shiftleft(bigint({asset_key}), {DAY_BITS + SOURCE_BITS}) "
        f"+ shiftleft(bigint({day_number(date_key)}), {SOURCE_BITS}) + {source})"
    )


def recency(date_key: str = "date_key", source_key: str = "source_key") -> str:
    """Sortable long: later date first, then lower source key; take the maximum."""
    return f"(shiftleft(bigint({date_key}), 32) - {source_key})"


def earliness(date_key: str = "date_key", source_key: str = "source_key") -> str:
    """Sortable long: earlier date first, then lower source key; take the minimum."""
    return f"(shiftleft(bigint({date_key}), 32) + {source_key})"


def number_after(rows: DataFrame, stored: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Adds ``key``: consecutive numbers above those of ``stored``, one per natural key.

    Keys are spread over hash buckets; each bucket is numbered on its own and shifted by
    the sizes of the buckets before it. Only the 4096 bucket sizes meet in one task. The
    bucket depends on the key alone, so a recomputed task repeats its numbers.
    """
    bucketed = rows.selectExpr("*", f"substr(md5({natural_key}), 1, {BUCKET_DIGITS}) AS _bucket")
    before = "OVER (ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    shifts = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .selectExpr("_bucket", f"coalesce(sum(_size) {before}, 0) AS _shift")
    )
    highest = stored.agg(F.expr(f"coalesce(max({key}), 0)")).scalar()
    within = f"row_number() OVER (PARTITION BY _bucket ORDER BY {natural_key})"
    # At most 4096 rows by construction.
    return (
        bucketed.join(F.broadcast(shifts), "_bucket")
        .withColumn(key, (highest + F.expr(f"_shift + {within}")).cast("int"))
        .drop("_bucket", "_shift")
    )
