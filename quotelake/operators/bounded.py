"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 100 MB of narrow per-asset rows, held once per executor.
MAX_BROADCAST_ROWS = 1_000_000


def fits(keys: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``keys`` has at most ``max_rows`` rows. On a stored table the count comes
    from the file footers."""
    return keys.count() <= max_rows


def broadcast_if(small: bool, side: DataFrame) -> DataFrame:
    """``side`` marked for broadcast when its bound was checked; else left to the shuffle
    join, whose hot partitions adaptive execution splits."""
    return F.broadcast(side) if small else side
