"""From raw documents to packed training sequences.

Quality rules, line dedup, n-gram Jaccard join, mixing, packing. Each stage is written to
the shared folder as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.llm import queries
from quotelake.session import staged

STAGES = [
    ("quality rules", queries.keep_good),
    ("line dedup", queries.drop_repeated_chunks),
    ("n-gram Jaccard join", queries.one_of_each_group),
    ("mixing", queries.mixed_documents),
    ("packing", queries.packed_documents),
]

# Estimates, rolling hashes and draws have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        rows = staged(stage(spark, rows, sf_dir), f"stage-{number}")
    return rows
