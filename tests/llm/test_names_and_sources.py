"""Columns of documents that clash with an operator's own, and what a mix does by source."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from quotelake.llm import line_chunks, mixing, outliers, queries, target_resampling, topk, tree_merge

CLASHING = [
    "removed", "kept_text", "row", "bad_id", "bad_key", "__key", "__row_key", "__copy", "held", "held_id", "held_key", "node",
    "gone_id", "drawn_id", "k_id", "k_text", "marks", "runs", "later", "copies", "m_id", "d_id", "col", "g", "parts", "rank", "drawn",
]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = text(70)
    texts = [text(rng.randint(25, 120)) for _ in range(60)] + [f"{text(20)} {passage} {text(15)}" for _ in range(6)]
    texts += [texts[3], texts[4], None, ""]
    rows = [(n, t, "en", ("a", "b", None)[n % 3], len(t or ""), *(["x"] * len(CLASHING))) for n, t in enumerate(texts)]
    names = ", ".join(f"`{name}` string" for name in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.mark.parametrize("stage", ["keep_good", "drop_repeated_chunks", "one_of_each_group", "mixed_documents"])
def test_stages_take_any_column_names(spark, documents, stage):
    found = getattr(queries, stage)(spark, documents, None)
    assert found.columns == documents.columns and found.count() > 0
    assert found.where(" AND ".join(f"`{name}` = 'x'" for name in CLASHING)).count() == found.count()


def test_operators_take_any_column_names(documents):
    for build in (
        tree_merge.without_copies, lambda rows: target_resampling.drawn_documents(rows, rows, percent=50),
    ):
        assert build(documents).count() > 0


def test_passages_replace_a_column_of_that_name(documents):
    found = line_chunks.dedup_passages(documents)
    assert found.columns.count("removed") == 1 and found.columns[-1] == "removed"
    # The passage in all but its first document, and two copies of whole documents.
    assert found.where("size(removed) > 0").count() == 7


def test_rows_of_one_id_and_text_in_several_sources_are_taken_by_source(spark):
    rows = [(1, "one two three", source, k) for k, source in enumerate("abc")]
    rows += [(10 + n, "word " * (n % 7 + 1), "abc"[n % 3], n) for n in range(30)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    mixed = mixing.mix(documents)
    wanted = Counter()
    for r in mixed.collect():
        wanted[r["doc_id"], r["source"]] += r["copies"]
    found = Counter((r["doc_id"], r["source"]) for r in mixing.repeated(documents, mixed).collect())
    assert found == +wanted


def test_small_sources_come_near_their_target(spark):
    rng = random.Random(8)
    rows, n = [], 0
    for source in range(12):
        for _ in range(rng.randint(4, 12)):
            rows.append((n, "w " * rng.choice((30, 70, 150, 400)), f"s{source:02d}"))
            n += 1
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sources = {}
    for r in mixing.mix(documents).collect():
        held = sources.setdefault(r["source"], {"target": r["target"], "taken": 0, "left": []})
        held["taken"] += r["size"] * r["copies"]
        assert r["copies"] <= 2
        if r["copies"] < 1 + (r["target"] >= r["source_size"]):
            held["left"].append(r["size"])
    for held in sources.values():
        off = held["target"] - held["taken"]
        # No document that was left out would bring the source nearer to its target.
        assert all(abs(off - size) >= abs(off) - 1 for size in held["left"])


def test_components_beyond_31_bits(spark):
    rows = [(0, [1e8, 1.0]), (1, [2e8, -3.5]), (50, [-1e8, 0.25]), (7, [0.5, 0.5]), (8, [3e9, 1e9]), (100, [float("inf"), 0.0])]
    found = topk.top_k(topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows if i != 100}
    wanted = []
    for query in (0, 50):
        scores = sorted(
            ((min(max(sum(a * b for a, b in zip(whole[query], v)), -(1 << 63)), (1 << 63) - 1), -i) for i, v in whole.items() if i != query),
            reverse=True,
        )
        wanted += [(query, rank, -i, score) for rank, (score, i) in enumerate(scores[:5], start=1)]
    assert sorted(map(tuple, found)) == wanted


def test_every_document_meets_an_estimate(spark):
    """The same odd document is judged alike among few documents and among many."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(500)]
    odd = " ".join("$#" + rng.choice(words) + "*%" for _ in range(60))
    for many, lang in ((30, "xx"), (80, "en")):
        rows = [(n, " ".join(rng.choice(words) for _ in range(60)), "en", f"s{n % 7}") for n in range(many)]
        rows.append((999, odd, lang, "small"))
        judged = outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
        kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
        assert not kept[999] and sum(kept.values()) == many
