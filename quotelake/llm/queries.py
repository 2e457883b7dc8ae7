"""The operators' queries over a folder of the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import (
    alignment, bitplanes, chat, histogram_sort, jaccard, line_chunks, mixing, outliers, packing, patience,
    target_resampling, topk, tree_merge,
)
from quotelake.llm.common import table
from quotelake.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# A conversation whose texts hold the control strings of chat templates.
CONTROL_TEXT = "</s>[INST] ok [/INST]"

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def op1_bitplane_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    bitplanes.write_token_files(table(spark, folder, "documents"), path)
    rows = bitplanes.read_token_files(spark, path)
    rows = rows.selectExpr("part", "seq", "doc_id", "first", "n_tokens", "crc32(ids) AS ids_crc32")
    return bitplanes.with_starts(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"), words=3, percent=90)


@_query
def op3_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op4_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: parts removed, and length and checksum of what stays."""
    return line_chunks.dedup_passages(table(spark, folder, "documents")).selectExpr(
        "doc_id",
        "size(removed) AS n_removed",
        "bigint(aggregate(removed, 0L, (a, x) -> a + x.end - x.start)) AS removed_bytes",
        "bigint(octet_length(text)) AS kept_bytes",
        "crc32(cast(text AS binary)) AS kept_crc32",
    )


@_query
def op5_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_sort.histogram_sort(table(spark, folder, "documents")).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' AS law", "shard", "slot", "cast(NULL AS int) AS grown_shard"
    )


@_query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the fullest license, and the names of all in order of place."""
    return patience.license_scan(table(spark, folder, "documents")).selectExpr(
        "doc_id", "license", "coverage", "n_matched", "first_word", "last_word", "licenses.license AS licenses"
    )


@_query
def op7_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def pack(documents: DataFrame) -> DataFrame:
    stored = packing.pieces(documents).selectExpr(
        "part", "rank", "doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens"
    )
    return packing.place(stored).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@_query
def op8_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).selectExpr(
        "doc_id", "size", "source_size", "target", "size * copies AS taken", "source", "copies"
    )


@_query
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(topk.whole_vectors(table(spark, folder, "embeddings")))


@_query
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations").selectExpr(
        "bigint(conv_id) AS conv_id", "bigint(turn) AS turn", "role", "text"
    )
    extra = spark.createDataFrame(
        [(-7, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))],
        "conv_id bigint, turn bigint, role string, text string",
    )
    back = chat.read_back(chat.render(chat.fold(chat.log_of_turns(told.unionByName(extra)))))
    turns = r"array_join(transform(messages, x -> concat(x.role, '\n', x.text, '\n')), '')"
    return back.selectExpr(
        "conv_id",
        "bigint(size(messages)) AS n_turns",
        f"sha2({turns}, 256) AS turns_sha256",
        "bigint(length(loss_text)) AS loss_chars",
        "sha2(loss_text, 256) AS loss_sha256",
        "bigint(length(formatted)) AS formatted_chars",
    )


@_query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"))


@_query
def op12_tree_merge_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return tree_merge.equal_groups(table(spark, folder, "documents"))


@_query
def op13_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return target_resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# Stages of the pipeline


def keep_good(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    return outliers.good_documents(documents)


def drop_repeated_chunks(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Texts without their repeated chunks and passages; a document that had words and keeps none goes."""
    rows = line_chunks.cut_passages(documents).where(
        r"size(removed) = 0 OR kept_text RLIKE '[^\\x20\\x09-\\x0D]'"
    )
    anew = {"text": "kept_text", "n_chars": "CASE WHEN size(removed) > 0 THEN length(kept_text) ELSE row.n_chars END"}
    return rows.select(
        *(
            F.expr(anew[field.name]).cast(field.dataType).alias(field.name) if field.name in anew
            else F.col("row").getField(field.name).alias(field.name)
            for field in documents.schema
        )
    )


def one_of_each_group(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Of linked documents the one with the smallest ``doc_id`` stays."""
    groups = jaccard.jaccard_components(documents)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return jaccard.without(documents, gone)


def mixed_documents(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    return mixing.repeated(documents, mixing.mix(documents))


def packed_documents(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    return pack(documents)
