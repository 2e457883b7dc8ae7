"""As-of join of two large tables: each left row with the newest right row at or before it.

No pairs are made. Both sides are put into one table and sorted by key and time, right rows
first at equal times; the row wanted is the last right row before a left row.

Keys with an ordinary number of rows are exchanged once by key and read in order by a window.
A key with more than ``hot_rows`` rows would be one task's work, so all such keys are range
partitioned by key and time instead: a hot key is spread over as many partitions as its rows
need. Inside a partition a window finds the last right row; for the first key of a partition it
may lie in an earlier one, so the last right row of each partition is carried over its edges.
The carry is one row per partition. Which way a key goes does not change its result, so when
there are more hot keys than can be broadcast, all keys are range partitioned.

Nulls and ties: a left row without key or time, or with no right row at or before it, keeps
null for the right columns. Right rows without key or time are not found. Of right rows with
equal key and time the one greatest by ``tie`` counts; then all its columns, in their order.
Repeated left rows each get their match. Either side may be empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.bounded import MAX_BROADCAST_ROWS
from quotelake.session import staged

HOT_ROWS = 5_000_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """``left`` with the ``columns`` of its newest right row at or before it. Both sides have
    ``key`` and ``time``; ``columns`` must not be columns of ``left``."""
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"the left rows already have {sorted(clash)}")
    names = list(left.columns)
    own = left.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{time}`").alias("t"), F.lit(1).alias("side"),
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("own"),
    )
    value = F.struct(
        F.struct(*(F.col(f"`{name}`") for name in tie or columns)).alias("tie"),
        F.struct(*(F.col(f"`{name}`") for name in columns)).alias("held"),
    )
    found = right.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{time}`").isNotNull()).select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{time}`").alias("t"), F.lit(0).alias("side"), value.alias("value")
    )
    both = own.unionByName(found, allowMissingColumns=True)
    sound = F.col("k").isNotNull() & F.col("t").isNotNull()
    hot = _hot_keys(own.where(sound).select("k"), found.select("k"), hot_rows)
    held = hot.count()
    if not held:
        joined = _in_keys(both.where(sound))
    elif held > MAX_BROADCAST_ROWS:
        joined = _in_ranges(both.where(sound), parts)
    else:
        hot = F.broadcast(hot)
        joined = _in_keys(both.where(sound).join(hot, "k", "left_anti")).unionByName(
            _in_ranges(both.where(sound).join(hot, "k", "left_semi"), parts)
        )
    lost = both.where(~sound & (F.col("side") == 1)).select("own", "value")
    return joined.unionByName(lost).select("own.*", *(F.col(f"value.held.`{name}`").alias(name) for name in columns))


def _hot_keys(one: DataFrame, other: DataFrame, hot_rows: int) -> DataFrame:
    """The keys with more rows than ``hot_rows``. There are at most as many as all rows by
    ``hot_rows``."""
    counts = one.unionByName(other).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return staged(counts.where(F.col("n") > hot_rows).select("k"), "asof-hot")


def _last_value(by: str) -> str:
    """SQL: the newest right row up to this row. Right rows come first at equal times."""
    order = "t, side, value.tie, value.held"
    return f"last(value, true) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _in_keys(both: DataFrame) -> DataFrame:
    return both.selectExpr("side", "own", f"{_last_value('k')} AS value").where("side = 1").select("own", "value")


def _in_ranges(both: DataFrame, parts: int | None) -> DataFrame:
    parts = parts or int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(both.repartitionByRange(parts, "k", "t").withColumn("part", F.spark_partition_id()), "asof-ranges")
    # From here to ``carries`` there is one row, or two, per partition.
    edges = staged(dealt.groupBy("part").agg(F.min("k").alias("first_key"), F.max("k").alias("last_key")), "asof-edges")
    newest = dealt.where("side = 0").join(F.broadcast(edges), "part").where("k = last_key").groupBy("part", "last_key").agg(
        F.expr("max(struct(t, value.tie, value.held))").alias("top")
    )
    # A key that goes on in a later partition is the last one of every partition it came from.
    told = newest.selectExpr("part", "last_key AS k", "1 AS turn", "struct(top.tie, top.held) AS value")
    asked = edges.selectExpr("part", "first_key AS k", "0 AS turn")
    before = "OVER (PARTITION BY k ORDER BY part, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    carries = told.unionByName(asked, allowMissingColumns=True).selectExpr(
        "part", "k", "turn", f"last(value, true) {before} AS carry"
    ).where("turn = 0 AND carry IS NOT NULL").select("part", "k", "carry")
    carries = staged(carries, "asof-carries")
    within = dealt.selectExpr("part", "k", "side", "own", f"{_last_value('part, k')} AS value").where("side = 1")
    met = within.join(F.broadcast(carries), ["part", "k"], "left")
    return met.select("own", F.coalesce("value", "carry").alias("value"))
