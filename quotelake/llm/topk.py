"""Exact top-k inner products by descending length and rotated partial sums.

Vectors hold whole numbers (``floor(scale * x)``). All rows are dealt out by descending
length into blocks; queries are blocks as well. Every pair of a query block and a candidate
block is one row of block rows, met by an equi-join on block numbers: this is a stated query
set against all rows, in blocks. Within a pair:

* a candidate block whose longest vector cannot reach a query's k-th score by the
  Cauchy-Schwarz bound is passed over;
* the vectors are rotated to the eigenvectors of their second-moment matrix (the right
  singular vectors of the table), so the first coordinates carry most of every product; a
  candidate goes on only if partial sum plus product of the residual lengths can reach
  the k-th score;
* what goes on is scored exactly in whole numbers.

The first candidate blocks (the longest vectors) are searched before the others and give
every query its first k-th score. Bounds carry an allowance for rounding, so pruning never
changes a result.

Nulls and edges: vectors that are null or hold null, infinite or undefined components take
no part, nor do rows without ``vec_id``; shorter vectors count as filled up with zeros, an
empty vector scores 0. Ties go to the smaller id. A row never answers its own query: rows
with the query's own id are left out. Scores must fit in a long, and components in 31 bits.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from quotelake.llm.common import map_arrow, partitions
from quotelake.session import shared_dir, staged

K = 5
SCALE = 256
EVERY = 50
BLOCK = 4096
QUERY_BLOCK = 1024
# Coordinates summed before each pruning.
LEADING = 16
# Shares of the candidate blocks that query blocks are sent to.
SHARES = 64
_BLOCKS = "block bigint, role int, ids binary, vectors binary, n int, longest double"
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``v`` (whole numbers) and ``norm2`` of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("e"))
    sound = (
        "vec_id IS NOT NULL AND e IS NOT NULL AND NOT exists(e, x -> x IS NULL OR isnan(x) "
        "OR x = cast('Infinity' AS double) OR x = cast('-Infinity' AS double))"
    )
    rows = rows.where(sound).selectExpr("vec_id", f"transform(e, x -> bigint(floor({scale} * double(x)))) AS v")
    return rows.withColumn("norm2", F.expr("aggregate(v, 0D, (a, x) -> a + double(x) * double(x))"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch, filled up with zeros."""
    lengths = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width).astype(np.int64)
    rows = np.zeros((len(lengths), width), dtype=np.int64)
    rows[np.arange(width) < lengths[:, None]] = values
    return rows


def _rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the second moments of all vectors, strongest first. Each task sums its
    own; the driver sees ``width`` by ``width`` numbers a group of tasks."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            vectors = _matrix(batch.column(0), width).astype(np.float64)
            total += vectors.T @ vectors
        where = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(total.ravel())], ["at", "s"])

    sums = map_arrow(rows.select("v"), moments, "at bigint, s double").groupBy("at").agg(F.sum("s").alias("s"))
    matrix = np.zeros(width * width)
    for row in sums.collect():
        matrix[row["at"]] = row["s"]
    _, vectors = np.linalg.eigh(matrix.reshape(width, width))
    return np.ascontiguousarray(vectors[:, ::-1])


def _blocks(rows: DataFrame, width: int, size: int, role: int) -> DataFrame:
    """Runs of ``size`` vectors of a partition as one row each, in order."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, vectors = TaskContext.get().partitionId(), 0, [], []

        def block() -> pa.RecordBatch:
            matrix = np.concatenate(vectors)
            longest = float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1).max()))
            columns = [pa.array([(part << 24) + number]), pa.array([role], pa.int32()),
                       pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
                       pa.array([matrix.astype("<i8").tobytes()], pa.binary()),
                       pa.array([len(matrix)], pa.int32()), pa.array([longest])]
            return pa.RecordBatch.from_arrays(columns, ["block", "role", "ids", "vectors", "n", "longest"])

        held = 0
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                piece = batch.slice(first, size)
                ids.append(piece.column(0).to_numpy(zero_copy_only=False))
                vectors.append(_matrix(piece.column(1), width))
                held += piece.num_rows
                while held >= size:
                    all_ids, all_vectors = np.concatenate(ids), np.concatenate(vectors)
                    ids, vectors = [all_ids[:size]], [all_vectors[:size]]
                    yield block()
                    ids, vectors, number, held = [all_ids[size:]], [all_vectors[size:]], number + 1, held - size
        if held:
            yield block()

    return map_arrow(rows.select("vec_id", "v"), gather, _BLOCKS)


def _scores(rows: np.ndarray, query: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products, none of which exceeds ``largest``. One that does not fit 64 bits
    is the nearest number that does."""
    if largest < 2.0**62:
        return rows @ query
    exact = rows.astype(object) @ query.astype(object)
    return np.array([min(max(score, -(1 << 63)), (1 << 63) - 1) for score in exact], dtype=np.int64)


def best_of(
    queries: tuple[np.ndarray, np.ndarray], candidates: tuple[np.ndarray, np.ndarray], rotation: np.ndarray, k: int,
    least: np.ndarray, leading: int = LEADING,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the candidates (ids and scores) among the k best that reach ``least``."""
    q_ids, q = queries
    c_ids, c = candidates
    q_length, c_length = np.sqrt((q.astype(np.float64) ** 2).sum(1)), np.sqrt((c.astype(np.float64) ** 2).sum(1))
    q_turned, c_turned = q @ rotation, c @ rotation
    q_rest = np.sqrt(np.maximum(q_length**2 - (q_turned[:, :leading] ** 2).sum(1), 0))
    c_rest = np.sqrt(np.maximum(c_length**2 - (c_turned[:, :leading] ** 2).sum(1), 0))
    partial = q_turned[:, :leading] @ c_turned[:, :leading].T
    for row in range(len(q_ids)):
        allowance = 1e-6 * (1 + q_length[row] * c_length)
        reach = partial[row] + q_rest[row] * c_rest + allowance
        open_ = reach >= least[row]
        open_ &= c_ids != q_ids[row]
        if not open_.any():
            continue
        at = np.flatnonzero(open_)
        if len(at) > 8 * k:
            # The likeliest candidates first; their k-th score prunes the others.
            first = at[np.argpartition(-reach[at], 4 * k)[: 4 * k]]
            floor = np.sort(_scores(c[first], q[row], q_length[row] * c_length[first].max()))[-k]
            at = at[reach[at] >= max(floor, least[row])]
        scores = _scores(c[at], q[row], q_length[row] * c_length[at].max(initial=0))
        order = np.lexsort((c_ids[at], -scores))[:k]
        order = order[scores[order] >= least[row]]
        yield int(q_ids[row]), c_ids[at][order], scores[order]


def _search(pairs: DataFrame, rotation: np.ndarray, width: int, k: int) -> DataFrame:
    """Rows with a query block (``q_*``, ``least``) and a candidate block to found candidates."""
    turned = rotation

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                q_ids = np.frombuffer(held["q_ids"], "<i8")
                q = np.frombuffer(held["q_vectors"], "<i8").reshape(-1, width)
                least = np.frombuffer(held["least"], "<f8") if held["least"] else np.full(len(q_ids), -np.inf)
                ids = np.frombuffer(held["ids"], "<i8")
                vectors = np.frombuffer(held["vectors"], "<i8").reshape(-1, width)
                # Queries that the block's longest vector cannot serve are passed over.
                lengths = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                may = lengths * held["longest"] * (1 + 1e-9) + 1e-6 >= least
                found = list(best_of((q_ids[may], q[may]), (ids, vectors), turned, k, least[may])) if may.any() else []
                if found:
                    query = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(np.concatenate([f[1] for f in found])),
                         pa.array(np.concatenate([f[2] for f in found]))],
                        ["query_id", "vec_id", "score"],
                    )

    return map_arrow(pairs.select("q_ids", "q_vectors", "least", "ids", "vectors", "longest"), search, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _paired(candidates: DataFrame, queries: DataFrame, n_queries: int, groups: int) -> DataFrame:
    """Each candidate block beside each query block, joined on the query block's number and
    one of ``groups`` shares of the candidate blocks, so that no key holds many pairs."""
    q = queries.selectExpr("row_id", "ids AS q_ids", "vectors AS q_vectors", "least")
    q = q.selectExpr("*", f"explode(sequence(0, {groups - 1})) AS share")
    several = candidates.selectExpr(
        "*", f"int(pmod(hash(block), {groups})) AS share", f"explode(sequence(0, {n_queries - 1})) AS row_id"
    )
    return several.join(q, ["row_id", "share"])


def top_k(
    vectors: DataFrame, queries: str = f"vec_id % {EVERY} = 0", k: int = K, block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best candidates of every query.

    ``vectors`` as from ``whole_vectors``; ``queries`` is SQL that picks the query rows.
    Repeated rows are candidates of their own; a query that repeats is asked once.
    """
    session = vectors.sparkSession
    rows = staged(vectors, "topk-vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if not width:
        width = 1
    rotation = _rotation(rows, width)
    n_rows = rows.count()
    parts = max(1, min(partitions(rows), -(-n_rows // block)))
    folder = shared_dir(session, "topk-blocks")
    by_length = rows.repartitionByRange(parts, F.desc("norm2"), "vec_id").sortWithinPartitions(F.desc("norm2"), "vec_id")
    _blocks(by_length, width, block, 0).write.parquet(folder)
    blocks = session.read.schema(_BLOCKS).parquet(folder).drop("role")
    asked = rows.where(queries).dropDuplicates(["vec_id", "v"])
    asked = staged(asked, "topk-asked")
    asked = asked.coalesce(max(1, -(-asked.count() // query_block)))
    query_rows = staged(_blocks(asked, width, query_block, 1).drop("role"), "topk-queries")
    # Query blocks are numbered; one row each, so the ordered task sees a row per block.
    numbers = query_rows.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("row_id"))
    numbers = staged(numbers, "topk-numbers")
    n_queries = numbers.count()
    if not n_queries:
        return session.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    query_rows = query_rows.join(numbers, "block").drop("block")
    first = blocks.agg(F.min("block")).first()[0]
    opening = _paired(blocks.where(F.col("block") == first), query_rows.withColumn("least", F.lit(None).cast("binary")), n_queries, 1)
    seeds = staged(_search(opening, rotation, width, k), "topk-first")
    kth = _ranked(seeds, k).where(F.col("rank") == k).select("query_id", "score")
    with_least = _least(query_rows, kth)
    rest = _paired(blocks.where(F.col("block") != first), with_least, n_queries, min(SHARES, parts))
    found = seeds.unionByName(_search(rest, rotation, width, k))
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _least(query_rows: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with each query's k-th score so far, in the order of their ids."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row_id, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                numbers = np.frombuffer(held, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row_id] * len(numbers), pa.int32()), pa.array(np.arange(len(numbers), dtype=np.int32)),
                     pa.array(numbers)], ["row_id", "at", "query_id"])

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("at").to_numpy())
        scores = table.column("score").to_numpy()[order]
        return pa.table({"row_id": pa.array([key[0].as_py()], pa.int32()),
                         "least": pa.array([scores.astype("<f8").tobytes()], pa.binary())})

    listed = map_arrow(query_rows.select("row_id", "ids"), ids, "row_id int, at int, query_id bigint")
    scored = listed.join(kth, "query_id", "left").select(
        "row_id", "at", F.coalesce(F.col("score").cast("double"), F.lit(float("-inf"))).alias("score")
    )
    # A group is a block of at most QUERY_BLOCK numbers.
    packed = scored.groupBy("row_id").applyInArrow(pack, "row_id int, least binary")
    return query_rows.join(packed, "row_id")
