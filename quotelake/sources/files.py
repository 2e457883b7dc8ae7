"""Small driver-side file steps, on any file system Spark can reach."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Codec of the stored tables, the lake and the published ones: they take a half to two thirds of
# the disk that the default codec needs.
CODEC = "zstd"


def _path(spark: SparkSession, path: str):
    """The path with its scheme, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(found), system


def read_parts(spark: SparkSession, schema: T.StructType, folder: str, parts: list[str]) -> DataFrame:
    """Some ``key=value`` parts of a Parquet folder as one scan, without the key."""
    rows = spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/{part}" for part in parts))
    return rows.select(*schema.fieldNames())


def names(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names of the files of a folder that match a glob pattern."""
    path, system = _path(spark, folder)
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern))
    return [status.getPath().getName() for status in found or []]


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


def newest(spark: SparkSession, folder: str, known: int = -1) -> int:
    """The largest number of the files ``0000000000.json``, ``0000000001.json``, ... of a
    folder, which have no gaps; -1 if there is none. ``known`` is one that is there. Probes
    upwards in doubling steps, so the calls grow with the logarithm of what is new."""
    if not exists(spark, numbered(folder, known + 1)):
        return known
    low, step = known + 1, 1
    while exists(spark, numbered(folder, low + step)):
        low, step = low + step, step * 2
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if exists(spark, numbered(folder, middle)) else (low, middle)
    return low


def numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:010d}.json"


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder and all below it, if it is there."""
    found, system = _path(spark, path)
    system.delete(found, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    found, system = _path(spark, path)
    return system.getContentSummary(found).getLength()


def text(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, content: str) -> bool:
    """Makes a whole file appear under a name at once; False, with nothing changed, when the
    name is taken.

    The content is written under a hidden name first. On a local disk a hard link then
    claims the name, elsewhere a rename that does not overwrite, which is atomic on HDFS. A
    store that can only copy has no such rename, so there one writer at a time is needed.
    """
    target, system = _path(spark, path)
    if target.toUri().getScheme() == "file":
        return _create_local(unquote(urlparse(target.toString()).path), content)
    if system.exists(target):
        return False
    hadoop = spark._jvm.org.apache.hadoop.fs
    hidden = hadoop.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    try:
        context.rename(hidden, target, options)
    except Exception:
        if system.exists(target):
            system.delete(hidden, False)
            return False
        raise
    return True


def _create_local(path: str, content: str) -> bool:
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f"_{uuid.uuid4().hex}")
    with open(hidden, "x", encoding="utf-8") as file:
        file.write(content)
        file.flush()
        os.fsync(file.fileno())
    try:
        os.link(hidden, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(hidden)
