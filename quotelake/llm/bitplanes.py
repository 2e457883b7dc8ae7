"""Token files: id blocks turned into planes, each plane compressed, with a chunk index.

A file image holds the ids of whole documents, cut into blocks of a fixed number of ids
(the last block is shorter). A block is transposed into byte planes (first all lowest
bytes, then the next ones) or bit planes, and every plane is compressed with zstandard by
itself, so that planes that hardly vary cost next to nothing. The chunk index holds the
compressed length of every plane of every block; documents and their lengths stand beside
it. Images are rows of a Parquet table: Spark's commit keeps a half-written task unseen, a
lost one is run again, and any split of the table is readable by itself.

Rows of the image table: ``part`` and ``seq`` (order of the documents), ``n_ids``,
``n_docs``, ``content`` (the image).

Nulls and edges: a null text is empty and has the end id alone; documents without id come
first; equal ids are ordered by text, and equal rows stay separate documents. A document
longer than an image makes an image of its own. An empty table gives an empty one. Other
columns of the documents are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from quotelake.llm.common import map_arrow, partitions, slices
from quotelake.llm.tokens import default_path, encode_documents

MAGIC = b"QLPLANE1"
_HEAD = struct.Struct("<8sBBHIQIII")
BLOCK_IDS = 65_536
IMAGE_IDS = 1 << 20
LEVEL = 3

FILES = "part int, seq int, n_ids bigint, n_docs int, content binary"
DOCUMENTS = "part int, seq int, doc_id bigint, first bigint, n_tokens bigint, ids binary"


def to_planes(block: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block of unsigned ids, lowest first."""
    width = block.dtype.itemsize
    rows = np.ascontiguousarray(block).view(np.uint8).reshape(len(block), width)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(plane, bitorder="little").tobytes() for plane in np.ascontiguousarray(rows.T)]
    return [plane.tobytes() for plane in np.ascontiguousarray(rows.T)]


def from_planes(planes: list[bytes], n_ids: int, width: int, bits: bool) -> np.ndarray:
    rows = np.stack([np.frombuffer(plane, dtype=np.uint8) for plane in planes])
    if bits:
        rows = np.unpackbits(rows, axis=1, count=n_ids, bitorder="little")
        rows = np.packbits(np.ascontiguousarray(rows.T), axis=1, bitorder="little")
    else:
        rows = np.ascontiguousarray(rows.T)
    return rows.reshape(n_ids * width).view(f"<u{width}")


def write_image(
    doc_ids: list[int | None], documents: list[bytes], block_ids: int = BLOCK_IDS, bits: bool = False, level: int = LEVEL
) -> bytes:
    """One file image from documents' ids (little-endian, 32 bits each)."""
    ids = np.frombuffer(b"".join(documents), dtype="<u4")
    width = 2 if len(ids) == 0 or int(ids.max()) < 1 << 16 else 4
    ids = ids.astype(f"<u{width}")
    squeeze = zstandard.ZstdCompressor(level=level).compress
    planes = [
        squeeze(plane) for first in range(0, len(ids), block_ids) for plane in to_planes(ids[first : first + block_ids], bits)
    ]
    keys = np.array([0 if key is None else key for key in doc_ids], dtype="<i8").tobytes()
    absent = np.array([key is None for key in doc_ids], dtype=np.uint8).tobytes()
    lengths = np.array([len(document) // 4 for document in documents], dtype="<u8").tobytes()
    heads = squeeze(keys + absent + lengths)
    index = squeeze(np.array([len(plane) for plane in planes], dtype="<u4").tobytes())
    head = _HEAD.pack(MAGIC, width, int(bits), 0, block_ids, len(ids), len(documents), len(heads), len(index))
    return b"".join([head, heads, index, *planes])


def read_image(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all token ids of a file image."""
    magic, width, bits, _, block_ids, n_ids, n_docs, n_heads, n_index = _HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    expand = zstandard.ZstdDecompressor().decompress
    at = _HEAD.size
    heads, at = expand(content[at : at + n_heads]), at + n_heads
    index, at = np.frombuffer(expand(content[at : at + n_index]), dtype="<u4"), at + n_index
    keys = np.frombuffer(heads, dtype="<i8", count=n_docs)
    absent = np.frombuffer(heads, dtype=np.uint8, offset=8 * n_docs, count=n_docs)
    lengths = np.frombuffer(heads, dtype="<u8", offset=9 * n_docs, count=n_docs).astype(np.int64)
    bounds = at + np.concatenate([[0], np.cumsum(index, dtype=np.int64)])
    per_block = width * 8 if bits else width
    blocks = []
    for number, first in enumerate(range(0, n_ids, block_ids)):
        planes = [
            expand(content[bounds[k] : bounds[k + 1]]) for k in range(number * per_block, (number + 1) * per_block)
        ]
        blocks.append(from_planes(planes, min(block_ids, n_ids - first), width, bool(bits)))
    ids = np.concatenate(blocks).astype("<u4") if blocks else np.zeros(0, "<u4")
    return [None if gone else int(key) for key, gone in zip(keys, absent)], lengths, ids


def token_images(
    documents: DataFrame, tokenizer: str | None = None, block_ids: int = BLOCK_IDS, image_ids: int = IMAGE_IDS,
    bits: bool = False,
) -> DataFrame:
    """The image rows of all documents, in ascending ``doc_id``.

    One exchange, of ids and texts, deals out ranges of ids; ids that repeat are parted by
    the text's hash, so no id is bound to one task unless its rows are equal.
    """
    path = tokenizer or default_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, keys, held, n_ids = TaskContext.get().partitionId(), 0, [], [], 0

        def image() -> pa.RecordBatch:
            content = write_image(keys, held, block_ids, bits)
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n_ids], pa.int64()),
                       pa.array([len(keys)], pa.int32()), pa.array([content], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "n_ids", "n_docs", "content"])

        for batch in slices(batches):
            found = encode_documents(path, batch.column(1).to_pylist())
            for key, ids in zip(batch.column(0).to_pylist(), found):
                keys.append(key)
                held.append(ids)
                n_ids += len(ids) // 4
                if n_ids >= image_ids:
                    yield image()
                    seq, keys, held, n_ids = seq + 1, [], [], 0
        if keys:
            yield image()

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text"))
    ranged = rows.repartitionByRange(partitions(rows), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return map_arrow(ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"), encode, FILES)


def write_token_files(documents: DataFrame, path: str, **options) -> None:
    token_images(documents, **options).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``part``, ``seq``, ``doc_id``, ``first`` (ids before it in
    its image), ``n_tokens``, ``ids``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            part, seq, content = (batch.column(k)[0].as_py() for k in range(3))
            keys, lengths, ids = read_image(content)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            step = 4096
            for at in range(0, len(keys), step):
                to, till = lengths[at : at + step], ends[at : at + step]
                columns = [
                    pa.array([part] * len(to), pa.int32()), pa.array([seq] * len(to), pa.int32()),
                    pa.array(keys[at : at + step], pa.int64()), pa.array(till - to, pa.int64()), pa.array(to, pa.int64()),
                    pa.array([bytes(raw[4 * (b - n) : 4 * b]) for n, b in zip(to, till)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "first", "n_tokens", "ids"])

    files = spark.read.schema(FILES).parquet(path).select("part", "seq", "content")
    return map_arrow(files, decode, DOCUMENTS)


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Adds ``start``, the ids of all documents before, from the files' own counts.

    Parts are summed first, so the one ordered task sees a row per part; images are summed
    along their part.
    """
    images = spark.read.schema(FILES).parquet(path).select("part", "seq", "n_ids")
    parts = images.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    before = F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before_part"))
    along = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    offsets = images.select("part", "seq", F.coalesce(along, F.lit(0)).alias("before_image")).join(parts, "part")
    joined = rows.join(offsets, ["part", "seq"])
    return joined.withColumn("start", F.expr("before_part + before_image + first")).drop(
        "part", "seq", "first", "before_part", "before_image"
    )
