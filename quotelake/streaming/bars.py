"""Event-time bars: a stream of ticks to open, high, low, close and volume per ticker and window.

Every micro-batch is aggregated to partial bars, merged with the bars still open, and split by
the new watermark (the latest tick seen less the allowed delay): bars whose window has ended
are appended to the finished ones, the others stay open. A tick whose window had ended before
its batch is late and goes to a side table as it is; it changes no bar. Only open bars are
state, so the state is bounded by tickers and delay, and a ticker with most of the ticks leaves
each task as one row per window.

Each table has a folder per batch. A batch counts once its commit is there, which is written
last; a batch that is replayed after a crash writes its folders anew, one that is committed
already is left alone. Readers leave out folders without a commit.

Nulls: a tick without ticker, time or price belongs to no bar and goes to the side table too.
Of ticks with equal time the one with the smaller ``seq`` came first; a null ``seq`` is the
smallest.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotelake import schemas as S
from quotelake.session import staged
from quotelake.sources import files
from quotelake.sources.warehouse import no_rows

TICKS = T.StructType(
    [
        T.StructField("ticker", T.StringType()), T.StructField("ts", S.STAMP), T.StructField("seq", T.LongType()),
        T.StructField("price", S.PRICE), T.StructField("volume", S.VOLUME),
    ]
)
_AT = T.StructType([T.StructField("ts", S.STAMP), T.StructField("seq", T.LongType()), T.StructField("price", S.PRICE)])
BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()), T.StructField("start", S.STAMP), T.StructField("end", S.STAMP),
        T.StructField("first", _AT), T.StructField("last", _AT), T.StructField("high", S.PRICE), T.StructField("low", S.PRICE),
        T.StructField("volume", T.DecimalType(28, 4)), T.StructField("n_ticks", T.LongType()),
    ]
)
HOUR, DAY = "1 hour", "1 day"


def partial_bars(ticks: DataFrame, every: str = HOUR) -> DataFrame:
    """One bar per ticker and window of these ticks."""
    windowed = ticks.withColumn("window", F.window("ts", every)).selectExpr(
        "ticker", "window.start AS start", "window.end AS end", "struct(ts, seq, price) AS first",
        "struct(ts, seq, price) AS last", "price AS high", "price AS low", "volume", "1L AS n_ticks",
    )
    return merged_bars(windowed)


def merged_bars(bars: DataFrame) -> DataFrame:
    """Parts of bars put together; the order of the parts does not matter."""
    rows = bars.groupBy("ticker", "start", "end").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.expr("sum(coalesce(volume, 0))").alias("volume"), F.sum("n_ticks").alias("n_ticks"),
    )
    return rows.selectExpr(*(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BARS.fields))


def coarser(bars: DataFrame, every: str = DAY) -> DataFrame:
    """Bars of a longer window out of finished shorter ones."""
    wide = bars.withColumn("window", F.window("start", every)).withColumns(
        {"start": F.col("window.start"), "end": F.col("window.end")}
    )
    return merged_bars(wide.select(*BARS.fieldNames()))


def prices(bars: DataFrame) -> DataFrame:
    """Bars as users see them."""
    return bars.selectExpr(
        "ticker", "start", "end", "first.price AS open", "high", "low", "last.price AS close", "volume", "n_ticks"
    )


class BarStore:
    """The tables of one bar stream."""

    def __init__(self, spark: SparkSession, root: str, every: str = HOUR, delay: str = "2 hours"):
        self.spark, self.root, self.every, self.delay = spark, root.rstrip("/"), every, delay
        self._known = -1

    def _commit(self, batch: int) -> dict:
        return json.loads(files.text(self.spark, files.numbered(f"{self.root}/commits", batch)))

    def last(self) -> int:
        """The newest committed batch; -1 before the first."""
        self._known = files.newest(self.spark, f"{self.root}/commits", self._known)
        return self._known

    def watermark(self) -> str | None:
        batch = self.last()
        return self._commit(batch)["watermark"] if batch >= 0 else None

    def _read(self, table: str, schema: T.StructType, first: int = 0) -> DataFrame:
        last = self.last()
        if last < 0:
            return no_rows(self.spark, schema)
        held = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(held).parquet(f"{self.root}/{table}")
        return rows.where(f"batch BETWEEN {first} AND {last}").drop("batch")

    def finished(self) -> DataFrame:
        return self._read("finished", BARS)

    def still_open(self) -> DataFrame:
        """The bars that ticks may still reach."""
        return self._read("open", BARS, max(0, self.last()))

    def late(self) -> DataFrame:
        return self._read("late", TICKS)

    def add(self, ticks: DataFrame, batch: int) -> None:
        """Takes one micro-batch into the bars."""
        last = self.last()
        if batch <= last:
            return
        if batch != last + 1:
            raise ValueError(f"batch {batch} does not follow batch {last} of {self.root}")
        before = self._commit(last)["watermark"] if batch else None
        ticks = ticks.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in TICKS.fields))
        whole = "ticker IS NOT NULL AND ts IS NOT NULL AND price IS NOT NULL"
        sound, late = ticks.where(whole), ticks.where(f"NOT ({whole})")
        if before:
            # A window of a null time drops the row, so the window is made of sound ticks only.
            dated = sound.withColumn("ended", F.window("ts", self.every).getField("end") <= F.lit(before).cast(S.STAMP))
            sound, late = dated.where("NOT ended").drop("ended"), late.unionByName(dated.where("ended").drop("ended"))
        fresh = partial_bars(sound, self.every)
        bars = staged(merged_bars(fresh.unionByName(self.still_open())) if batch else fresh, "bars")
        # One row reaches the driver.
        newest = bars.selectExpr(f"max(last.ts) - INTERVAL '{self.delay}' AS mark")
        mark = newest.selectExpr(f"string(greatest(mark, CAST({_text(before)} AS TIMESTAMP_NTZ)))").first()[0]
        done = F.lit(False) if mark is None else F.col("end") <= F.lit(mark).cast(S.STAMP)
        for table, rows in (("finished", bars.where(done)), ("open", bars.where(~done)), ("late", late)):
            rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch}")
        commit = json.dumps({"batch": batch, "watermark": mark})
        files.create(self.spark, files.numbered(f"{self.root}/commits", batch), commit)


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def start_bars(
    ticks: DataFrame, store: BarStore, checkpoint: str, every_minutes: int | None = None
) -> StreamingQuery:
    """Takes every micro-batch of ``ticks`` into the store; without an interval, what is there,
    then ends. A checkpoint belongs to its store."""
    writer = ticks.writeStream.foreachBatch(store.add).option("checkpointLocation", checkpoint)
    if every_minutes is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_minutes} minutes").start()
