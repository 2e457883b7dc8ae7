"""Quantiles and distinct counts per asset and month from mergeable sketches.

Each load adds a folder of sketches of the facts it added; an answer merges the sketches it
asks for and never reads a fact. Merging is exact in the sense that sketches of parts merged
are as good as one sketch of the whole, so neither the number of loads nor their order matters
beyond the stated error: ranks within ``RANK_ERROR`` (KLL, k = 400), distinct counts within
``COUNT_ERROR`` (HyperLogLog, 2**14 registers), each for a single answer with 99 % probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources import files
from quotelake.sources.warehouse import Warehouse, no_rows

KLL_K, HLL_LOG = 400, 14
RANK_ERROR, COUNT_ERROR = 0.0085, 0.025
SKETCHES = T.StructType(
    [
        T.StructField("asset_key", T.IntegerType()), T.StructField("month", T.IntegerType()),
        T.StructField("closes", T.BinaryType()), T.StructField("distinct_closes", T.BinaryType()),
        T.StructField("n_quotes", T.LongType()),
    ]
)


def sketched(facts: DataFrame) -> DataFrame:
    """Sketches of these facts per asset and month (as yyyymm), combined map-side."""
    return facts.groupBy("asset_key", F.expr("int(date_key div 100)").alias("month")).agg(
        F.kll_sketch_agg_double(F.col("close_price").cast("double"), KLL_K).alias("closes"),
        F.hll_sketch_agg(F.col("close_price").cast("string"), HLL_LOG).alias("distinct_closes"),
        F.count(F.lit(1)).alias("n_quotes"),
    )


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches put together by some of their keys."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("closes").alias("closes"), F.hll_union_agg("distinct_closes").alias("distinct_closes"),
        F.sum("n_quotes").alias("n_quotes"),
    )


def answers(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Approximate quantiles of the close (``q25``, ``q50``, ...) and its number of values."""
    keys = [name for name in sketches.columns if name in ("asset_key", "month")]
    return sketches.select(
        *keys,
        *(F.kll_sketch_get_quantile_double("closes", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles),
        F.hll_sketch_estimate("distinct_closes").alias("n_distinct"), "n_quotes",
    )


class SketchStore:
    """The sketches beside a warehouse, one folder per load it has taken in."""

    def __init__(self, house: Warehouse):
        self.house, self.spark, self.root = house, house.spark, f"{house.root}/sketches"

    def taken(self) -> int:
        """The newest load whose facts are in the sketches."""
        names = files.names(self.spark, self.root, "to=*")
        done = [name for name in names if files.exists(self.spark, f"{self.root}/{name}/_SUCCESS")]
        return max((int(name.split("=")[1]) for name in done), default=0)

    def refresh(self) -> int:
        """Takes in the facts of the loads since the last refresh; only these are read. A folder
        counts once Spark has marked it as written, and a dead attempt's is written anew."""
        base, before = self.house.pinned(), self.taken()
        load = base.last["load"]
        if load > before:
            rows = sketched(base.facts(after_load=before))
            rows.write.mode("overwrite").parquet(f"{self.root}/to={load:010d}")
        return load

    def sketches(self) -> DataFrame:
        last = self.taken()
        if not last:
            return no_rows(self.spark, SKETCHES)
        held = T.StructType([*SKETCHES.fields, T.StructField("to", T.LongType())])
        return self.spark.read.schema(held).parquet(self.root).where(f"to <= {last}").drop("to")
