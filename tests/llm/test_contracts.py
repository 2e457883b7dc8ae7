"""Columns and types of every registered operator query."""

from __future__ import annotations

import pytest

from quotelake.llm import queries

LONG = "bigint"
WANTED = {
    "op1_bitplane_tokens": dict(doc_id=LONG, start=LONG, n_tokens=LONG, ids_crc32=LONG),
    "op2_jaccard_join": dict(doc_id=LONG, n_shingles=LONG, component_id=LONG),
    "op3_robust_outliers": dict(
        doc_id=LONG, n_words=LONG, word_chars=LONG, n_symbols=LONG, n_dup_lines=LONG, n_repeat_words=LONG,
        base_failed="boolean", kept="boolean",
    ),
    "op5_histogram_shards": dict(
        doc_id=LONG, size=LONG, text_crc32=LONG, law="string", shard="int", slot=LONG, grown_shard="int"
    ),
    "op7_packed_sequences": dict(
        doc_id=LONG, start=LONG, length=LONG, ids_crc32=LONG, doc_tokens=LONG, sequence_id=LONG, offset=LONG
    ),
    "op8_pareto_mix": dict(doc_id=LONG, size=LONG, source_size=LONG, target="double", taken=LONG),
    "op9_exact_top_k": dict(query_id=LONG, rank="int", vec_id=LONG, score=LONG),
    "op10_chat_format": dict(
        conv_id=LONG, n_turns=LONG, turns_sha256="string", loss_chars=LONG, loss_sha256="string", formatted_chars=LONG
    ),
    "op11_token_alignment": dict(
        doc_id=LONG, n_a=LONG, n_b=LONG, n_groups=LONG, n_links=LONG, n_best=LONG, count_sum=LONG, groups_sha256="string"
    ),
    "op12_tree_merge_dedup": dict(doc_id=LONG, keep_id=LONG, group_size=LONG, kept="boolean", text_sha256="string"),
    "op13_target_resampling": dict(doc_id=LONG, n_features=LONG, weight=LONG, score=LONG, rank=LONG),
}


@pytest.mark.parametrize("name", sorted(WANTED))
def test_columns_and_types(spark, name):
    found = queries.queries()[name](spark, "/root/testdata/sf0.001")
    assert list(WANTED[name].items()) == found.dtypes[: len(WANTED[name])]


def test_every_number_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
