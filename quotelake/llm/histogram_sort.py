"""Histogram sort into shards of nearly equal bytes, with DataFrame functions only.

The sort key is the hash of the text, then ``doc_id``: copies of a text lie side by side.
Splitters are found by counting bytes below candidate boundaries (``cuts``), refined until
each meets the tolerance, and then the rows are exchanged once, by the finer bucket between
two splitters. A run of equal texts of up to ``WHOLE`` of a shard's even share stays in one
shard, which then ends at the nearer end of the run and misses the tolerance by up to half the
run at either end; a heavier run is parted where the splitter falls. Within a shard buckets may
part a run.

Slots number a shard's rows in key order. Buckets are many to a shard and are ordered one by
one, so no task sorts a shard.

Nulls and edges: a null text has no bytes and the checksum 0; documents without id sort
first; equal rows are neighbours. An empty table gives no rows. Columns that ``documents``
has besides are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.cuts import Cut, cuts, signed
from quotelake.session import staged

SHARDS = 24
# A row's own bytes beside its text.
ROW_BYTES = 8
# Of a shard's even share.
TOLERANCE = 0.005
WHOLE = 0.05
ROWS_PER_BUCKET = 1_000_000
BUCKETS_PER_SHARD = (8, 170)
_KEYS = ["text_key", "id_key"]


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and the sort key of every document."""
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).selectExpr(
        "doc_id",
        f"bigint(coalesce(octet_length(text), 0) + {ROW_BYTES}) AS size",
        "crc32(cast(coalesce(text, '') AS binary)) AS text_crc32",
        "xxhash64(coalesce(text, '')) AS text_key",
        f"coalesce(doc_id, {-(1 << 63)}) AS id_key",
    )


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> tuple[list[tuple[int, ...] | None], int]:
    """The boundaries of all buckets in key order and the buckets per shard."""
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    low, high = BUCKETS_PER_SHARD
    per_shard = min(high, max(low, math.ceil((count or 0) / shards / ROWS_PER_BUCKET)))
    total = int(total or 0)
    rows = rows.withColumn("all", F.lit(0).cast("bigint"))
    slack = {0: total / shards * tolerance}
    targets = [total * k // shards for k in range(1, shards)]
    outer = cuts(rows, "all", _KEYS, "size", {0: targets}, slack, whole=WHOLE * total / shards)[0]
    # The nearest boundaries of two wanted weights can lie in either order only if they are equal.
    ends = [Cut(0, 0), *sorted(outer), Cut(1 << 128, total)]
    targets = [
        start.below + (end.below - start.below) * k // per_shard
        for start, end in itertools.pairwise(ends) for k in range(1, per_shard)
    ]
    inner = iter(cuts(rows, "all", _KEYS, "size", {0: targets}, slack)[0])
    boundaries = []
    for start, end in itertools.pairwise(ends):
        held = (next(inner).boundary for _ in range(1, per_shard))
        boundaries += sorted(min(max(at, start.boundary), end.boundary) for at in held)
        boundaries.append(end.boundary)
    return [signed(boundary, 2) for boundary in boundaries[:-1]], per_shard


def bucket_of(boundaries: list[tuple[int, ...] | None]) -> F.Column:
    """How many boundaries lie at or below a row's key, by halving."""
    real = [pair for pair in boundaries if pair is not None]
    if not real:
        return F.lit(0)
    listed = ", ".join(f"named_struct('k', {k}L, 't', {t}L)" for k, t in real).replace(
        "-9223372036854775808L", "(-9223372036854775807L - 1L)"
    )
    depth = len(real).bit_length()
    above = f"named_struct('k', text_key, 't', id_key) >= element_at(array({listed}), int((a.lo + a.hi) div 2) + 1)"
    halve = (
        f"CASE WHEN a.lo >= a.hi THEN a WHEN {above} "
        "THEN named_struct('lo', int((a.lo + a.hi) div 2 + 1), 'hi', a.hi) "
        "ELSE named_struct('lo', a.lo, 'hi', int((a.lo + a.hi) div 2)) END"
    )
    return F.expr(
        f"aggregate(sequence(1, {depth}), named_struct('lo', 0, 'hi', {len(real)}), (a, i) -> {halve}, a -> a.lo)"
    )


def histogram_sort(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, the key columns, ``shard`` and ``slot`` of every document."""
    rows = staged(keyed(documents), "sort-keys")
    boundaries, per_shard = splitters(rows, shards, tolerance)
    # Stored: joined with its own counts, the bucket's expression can lose its columns in Spark's plan.
    rows = staged(rows.withColumn("bucket", bucket_of(boundaries)), "sort-buckets")
    # One row per bucket: bounded by shards times BUCKETS_PER_SHARD.
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    shard = F.floor(F.col("bucket") / per_shard).cast("int")
    before = Window.partitionBy(shard).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket").orderBy("text_key", "id_key")
    ranked = rows.withColumn("rank", F.row_number().over(within))
    return ranked.join(F.broadcast(offsets), "bucket").select(
        "doc_id", "size", "text_crc32", "text_key", "id_key",
        shard.alias("shard"), (F.col("before") + F.col("rank") - 1).alias("slot"),
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The texts themselves, in one folder per shard and in key order within each file."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").selectExpr(
        "*", "xxhash64(coalesce(text, '')) AS text_key", f"coalesce(doc_id, {-(1 << 63)}) AS id_key"
    )
    boundaries, per_shard = splitters(staged(keyed(documents), "sort-keys"), shards)
    rows = rows.withColumn("bucket", bucket_of(boundaries)).withColumn("shard", F.floor(F.col("bucket") / per_shard))
    ordered = rows.repartition(shards * per_shard, "bucket").sortWithinPartitions("shard", "text_key", "id_key")
    ordered.select("doc_id", "text", "shard").write.partitionBy("shard").parquet(path)
