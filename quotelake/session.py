"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from quotelake.sources import files

# Set in the builder only; nothing below changes a session that somebody else made.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot key is worth an extra exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A repeated JSON key keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "quotelake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings; ``extra`` holds more settings by full name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Folders handed out inside the innermost ``consumed`` block of this thread.
_made: ContextVar[list[tuple[str, str]] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Without that setting a local session gets a
    temporary folder, and a cluster session an error: a machine's own folder would lose
    data with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="quotelake-")
    path = f"{base.rstrip('/')}/quotelake/{purpose}-{uuid.uuid4().hex[:12]}"
    if (made := _made.get()) is not None:
        made.append((purpose, path))
    return path


@contextmanager
def consumed(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Deletes at its end the intermediate folders made inside it, but for the purposes in
    ``keep``: so a step holds no more of the disk than its successor still reads. What leaves
    the block must read kept folders only. A block around it takes over what was kept."""
    outer = _made.get()
    token = _made.set([])
    try:
        yield
    finally:
        inner = _made.get()
        _made.reset(token)
        for purpose, path in inner:
            if purpose not in keep:
                files.delete(spark, path)
            elif outer is not None:
                outer.append((purpose, path))


def drop_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of steps that have ended. It does so when the driver's
    JVM collects their objects, which a driver with room in its heap puts off for many steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(rows: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``rows`` written to the shared folder and read back, for results used several times:
    they are computed once, and a lost executor costs no more than its own step. ``codec`` is
    that of the files, if not the session's."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path, compression=codec)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
