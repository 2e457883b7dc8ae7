"""Global numbering without a one-task window.

Rows are range-partitioned and sorted on the wanted order and written once. A row's place in
its partition and the numbers of rows in the partitions before it give its number: the second
pass reads one count per partition, of which there are as many as partitions.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.session import staged

# monotonically_increasing_id holds the partition above these bits and the place below.
_PLACE_BITS = 33
_PART = f"shiftright(place, {_PLACE_BITS})"
_WITHIN = f"place & {(1 << _PLACE_BITS) - 1}L"


def numbered(rows: DataFrame, order: list[Column], name: str = "number", parts: int | None = None) -> DataFrame:
    """``rows`` with ``name``, their number from 0 in the order of ``order``.

    The rows are exchanged once, over ``parts`` range partitions. Rows that are equal in
    ``order`` lie in one partition and are numbered in any sequence, so ``order`` should end
    in a key. An empty table gives no rows. ``rows`` must not have a column ``name``.
    """
    if name in rows.columns:
        raise ValueError(f"the rows already have a column {name}")
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        F.struct(*(F.col(f"`{column}`") for column in rows.columns)).alias("held"),
        F.monotonically_increasing_id().alias("place"),
    )
    placed = staged(placed, "numbering").withColumn("part", F.expr(_PART))
    counts = sorted(placed.groupBy("part").count().collect())
    sizes = [entry["count"] for entry in counts]
    firsts = [(entry["part"], first) for entry, first in zip(counts, accumulate(sizes, initial=0))]
    first = F.broadcast(spark.createDataFrame(firsts, "part bigint, first bigint"))
    return placed.join(first, "part").select("held.*", (F.col("first") + F.expr(_WITHIN)).alias(name))
