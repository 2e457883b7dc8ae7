"""Copies of a text stay in one shard unless they weigh more than a stated share of it."""

from __future__ import annotations

from collections import defaultdict

from quotelake.llm import histogram_sort


def test_light_runs_are_not_parted(spark):
    # Two hundred texts of ten copies each: a run is 3.5 % of a shard, and splitters fall into runs.
    rows = spark.range(2000).selectExpr("id AS doc_id", "repeat(string(id % 200 + 100), 5) AS text")
    found = histogram_sort.histogram_sort(rows, 7).collect()
    shards, sizes, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in found:
        shards[r.text_key].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append((r.slot, r.text_key, r.id_key))
    assert len(found) == 2000 and all(len(held) == 1 for held in shards.values())
    run = 10 * found[0].size
    even = 2000 * found[0].size / 7
    assert sorted(sizes) == list(range(7)) and all(abs(size - even) <= run for size in sizes.values())
    for held in slots.values():
        assert [s for s, *_ in sorted(held)] == list(range(len(held)))
        assert [k[1:] for k in sorted(held)] == sorted(k[1:] for k in held)


def test_a_run_that_outweighs_a_shard_is_parted(spark):
    rows = spark.range(1000).selectExpr("id AS doc_id", "CASE WHEN id < 600 THEN 'same' ELSE string(id + 1000) END AS text")
    sizes = defaultdict(int)
    for r in histogram_sort.histogram_sort(rows, 4).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 4 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_runs_of_nearly_a_shard_do_not_make_shards_uneven(spark):
    texts = "CASE WHEN id % 6 < 4 THEN repeat(string(id % 6), 20) ELSE lpad(string(id), 20, 'x') END AS text"
    sizes = defaultdict(int)
    for r in histogram_sort.histogram_sort(spark.range(4800).selectExpr("id AS doc_id", texts), 6).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 6 and max(sizes.values()) < 1.08 * min(sizes.values())


def test_written_shards_hold_every_text_once_in_order(spark):
    from quotelake.session import shared_dir

    rows = spark.range(3000).selectExpr(
        "IF(id = 7, NULL, id) AS doc_id", "CASE WHEN id % 50 > 0 THEN repeat(string(id * 7919 % 500), 1 + int(id % 9)) END AS text"
    )
    path = shared_dir(spark, "shards")
    histogram_sort.write_shards(rows, path, shards=5)
    found = spark.read.parquet(path).selectExpr("doc_id", "text", "shard", "coalesce(octet_length(text), 0) + 8 AS size").collect()
    told = {r.doc_id: r.shard for r in histogram_sort.histogram_sort(rows, 5).collect()}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found))) == sorted(repr((r.doc_id, r.text)) for r in rows.collect())
    assert all(told[r.doc_id] == r.shard for r in found)
