"""The polled queue as a stream: new lake files are loaded as they arrive."""

from __future__ import annotations

import itertools
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake import schemas as S
from quotelake.plans.etl import MAX_FOLDERS, load_records
from quotelake.sources.warehouse import Warehouse, compact

log = logging.getLogger(__name__)

# Fixed value: the shortest polling interval.
MIN_MINUTES = 1


def landing_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Lake records from the files that appear in a folder, each file once."""
    reader = spark.readStream.schema(S.LAKE).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start_ingest(
    house: Warehouse, records: DataFrame, checkpoint: str, every_minutes: int | None = None
) -> StreamingQuery:
    """Loads every micro-batch of ``records``; without an interval, what is there, then ends.

    A batch replayed after a crash finds its commit and is left alone, or finds none and is
    loaded anew; what the dead attempt wrote is never read. A commit holds the newest batch
    of each stream, by the id in its checkpoint: with a new checkpoint all files are read again, and their quotes that are
    stored already are dropped by the load's anti-join. Late quotes are new keys and are
    added. So the stream needs no state.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if house.last["streams"].get(stream_id, -1) < batch_id:
            load_records(house, batch, stream_id=stream_id, batch_id=batch_id)
            if house.folder_count() > MAX_FOLDERS:
                compact(house, least=8)

    writer = records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if every_minutes is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{max(MIN_MINUTES, every_minutes)} minutes").start()


def keep_ingesting(
    house: Warehouse,
    path: str,
    checkpoint: str,
    every_minutes: int,
    rounds: int | None = None,
    on_failure: Callable[[Exception], None] = log.exception,
) -> int:
    """Polls a folder and outlives failed rounds; returns how many failed.

    A round loads what is there. When it fails, ``on_failure`` gets the error and the next
    round takes the same files again from the checkpoint. Without ``rounds`` it never ends.
    """
    failed = 0
    for number in itertools.count() if rounds is None else range(rounds):
        if number:
            time.sleep(60 * max(MIN_MINUTES, every_minutes))
        try:
            start_ingest(house, landing_stream(house.spark, path), checkpoint).awaitTermination()
        except Exception as error:  # a failed round must not end the polling
            failed += 1
            on_failure(error)
    return failed
