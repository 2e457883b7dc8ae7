"""Shortest-pack-first packing of documents into sequences of a fixed length.

Documents are tokenized and cut into pieces: full sequences and a rest. The histogram of
piece lengths has at most ``length`` bins however many documents there are; on it the
packing is computed, longest length first, each time into the packs that are filled least.
Packs of one history stand together as a pattern with a count, and a step splits or moves a
whole pattern. The pieces then find their places by rank: the k-th piece of a length takes
the k-th place that the patterns have for that length.

Ranks need no task that sees all pieces of a length: a piece is numbered in its own task,
and the counts of tasks are summed per length. The piece table is written to the shared
folder before that, so numbers and counts belong to the same run of each task.

Nulls and edges: a null text is empty, a document's only id is then the end id. Documents
with equal or no id are packed like others. An empty table gives no pieces. Other columns
are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from quotelake.llm.common import map_arrow, slices
from quotelake.llm.tokens import default_path, encode_documents
from quotelake.session import shared_dir

LENGTH = 2048
PIECES = "part int, doc_id bigint, start bigint, length bigint, doc_tokens bigint, rank bigint, ids binary"
_RANKS = 1 << 40


class Place(NamedTuple):
    """Pieces of ``length`` with ranks from ``first`` on, ``count`` of them, lie at ``offset``
    of the sequences from ``sequence`` on, one in each."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> tuple[list[Place], Counter]:
    """Places for all pieces, and the packing patterns (piece lengths) with their counts."""
    # Patterns by free space: packs of consecutive numbers that hold the same lengths.
    free: dict[int, list[tuple[int, int, tuple[int, ...]]]] = {}
    widest: list[int] = []
    places, sequences = [], 0

    def put(space: int, first: int, count: int, held: tuple[int, ...]) -> None:
        if space not in free or not free[space]:
            heapq.heappush(widest, -space)
        free.setdefault(space, []).append((first, count, held))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        if not 0 < size <= length:
            raise ValueError(f"a piece of {size} tokens")
        while left:
            while widest and not free.get(-widest[0]):
                heapq.heappop(widest)
            space = -widest[0] if widest else 0
            if space >= size:
                first, count, held = free[space].pop()
            else:
                space, first, count, held = length, sequences, left, ()
                sequences += left
            taken = min(left, count)
            if count > taken:
                put(space, first + taken, count - taken, held)
            places.append(Place(size, rank, taken, first, length - space))
            put(space - size, first, taken, (*held, size))
            left, rank = left - taken, rank + taken
    patterns: Counter = Counter()
    for groups in free.values():
        for _, count, held in groups:
            patterns[held] += count
    return places, patterns


def pieces(documents: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """Tokenized pieces, stored once: ``part`` and ``rank`` number the pieces of one length."""
    path = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in slices(batches):
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encode_documents(path, batch.column(1).to_pylist())):
                total = len(ids) // 4
                for start in range(0, total, length):
                    size = min(length, total - start)
                    rows.append((part, key, start, size, total, seen[size], ids[4 * start : 4 * (start + size)]))
                    seen[size] += 1
            kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start", "length", "doc_tokens", "rank", "ids"])

    rows = map_arrow(documents.select(F.col("doc_id").cast("bigint"), F.col("text")), cut, PIECES)
    folder = shared_dir(documents.sparkSession, "pieces")
    rows.write.option("compression", "zstd").parquet(folder)
    return documents.sparkSession.read.schema(PIECES).parquet(folder)


def place(stored: DataFrame, length: int = LENGTH) -> DataFrame:
    """Replaces ``part`` and ``rank`` of stored pieces by ``sequence_id`` and ``offset``;
    further columns stay. Only the histogram, at most ``length`` rows, reaches the driver."""
    counts = stored.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, _ = shortest_pack_first(histogram, length)
    table = np.array(sorted(places), dtype=np.int64).reshape(-1, 5)
    keys = table[:, 0] * _RANKS + table[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            found = table[np.searchsorted(keys, sizes * _RANKS + ranks, side="right") - 1]
            columns = [batch.column(name) for name in kept]
            columns += [pa.array(found[:, 3] + ranks - found[:, 1]), pa.array(found[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    earlier = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = stored.join(earlier, ["part", "length"]).withColumn("rank", F.expr("rank + before")).drop("part", "before")
    kept = [name for name in numbered.columns if name != "rank"]
    kinds = dict(numbered.dtypes)
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in kept) + ", sequence_id bigint, offset bigint"
    return map_arrow(numbered, look_up, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (little-endian, unpadded), ``doc_ids``, ``starts``.
    A sequence's pieces number at most its length, so a group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).selectExpr(
        "sequence_id",
        "aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x)) AS ids",
        "p.doc_id AS doc_ids",
        "p.start AS starts",
    )
