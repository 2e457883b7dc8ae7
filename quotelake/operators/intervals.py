"""Rows to the validity range they fall in.

A range join without pairs: ranges are repeated once per time bin they touch, rows get the bin
of their day, both meet on key and bin, and the exact test follows. Bins are calendar years,
and a range is cut to the years that rows have, so an open range is repeated as often as there
are years of rows and no more. A row meets only the ranges of its key and year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.bounded import broadcast_if, fits
from quotelake.session import staged


def valid_at(
    rows: DataFrame, versions: DataFrame, key: str, day: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """``rows`` with the columns of the version of their ``key`` that is valid at ``day``:
    ``valid_from <= day < valid_to``; a null end is open. Rows without a valid version have
    none (inner join); a row in two overlapping ranges comes twice. Column names of both
    sides but ``key`` must differ."""
    clash = set(rows.columns) & set(versions.columns) - {key}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    first, last = rows.agg(F.min(F.year(day)), F.max(F.year(day))).first()
    if first is None:
        return rows.join(versions, key).limit(0)
    years = f"sequence(greatest(year({valid_from}), {first}), least(coalesce(year({valid_to}), {last}), {last}))"
    touched = f"year({valid_from}) <= {last} AND coalesce(year({valid_to}), {last}) >= {first}"
    binned = versions.where(touched).withColumn("_bin", F.explode(F.expr(years)))
    binned = staged(binned, "version-years")
    met = rows.withColumn("_bin", F.year(day)).join(broadcast_if(fits(binned), binned), [key, "_bin"])
    inside = f"{day} >= {valid_from} AND ({valid_to} IS NULL OR {day} < {valid_to})"
    return met.where(inside).drop("_bin")
