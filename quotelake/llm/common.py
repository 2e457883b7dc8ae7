"""What the training-data operators share: words, Arrow slices, partition counts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import quotelake

# Fixed value: the white space that parts words.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_sql(text: str) -> str:
    """SQL: the array of a text's words; a null text has none."""
    return f"array_remove(split(coalesce({text}, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), '')"


def partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that what a task holds beside its batch stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``value`` computed once and bound to ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application; Spark copies the archive."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="quotelake-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = Path(quotelake.__file__).resolve().parent
        context.addPyFile(shutil.make_archive(f"{folder}/quotelake_code", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def map_arrow(
    rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function that uses this package."""
    _ship(rows.sparkSession)
    return rows.mapInArrow(function, schema)
