"""Texts are cut in one pass, and only those with something marked are read again; documents that
share an id are told apart by their texts."""

from __future__ import annotations

import random

import pytest

from quotelake.llm import line_chunks, passages


def some_words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]


def test_texts_with_nothing_marked_are_read_once(spark, monkeypatch):
    rng = random.Random(9)
    passage = some_words(rng, 60)
    texts = [(k, " ".join(some_words(rng, 120))) for k in range(30)]
    texts += [(30 + k, " ".join([*some_words(rng, 40), *passage, *some_words(rng, 40)])) for k in range(2)]
    read = []

    def counted(rows, function, schema, plain=line_chunks.map_arrow):
        read.append(rows.count())
        return plain(rows, function, schema)

    monkeypatch.setattr(line_chunks, "map_arrow", counted)
    monkeypatch.setattr(passages, "map_arrow", counted)
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: r.text for r in line_chunks.dedup_passages(documents).collect()}
    assert {k for k, text in texts if found[k] != text} == {31}
    assert sorted(read)[-1] == len(texts) and sorted(read)[-2] <= 2, read


@pytest.mark.parametrize("ids", [lambda k: k, lambda k: k // 3, lambda k: None if k % 2 else k])
def test_windows_go_in_order_of_id_and_text(spark, ids):
    rng = random.Random(13)
    shared = some_words(rng, 150)
    texts = []
    for k in range(24):
        low = rng.randint(0, 60)
        part = shared[low : low + rng.randint(50, 90)]
        texts.append([*some_words(rng, 20), *part, *some_words(rng, 20), *(part if k % 4 == 0 else [])])
    rows = [(ids(k), " ".join(text)) for k, text in enumerate(texts)]
    rows.append(rows[3])
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    hashes = {r.text: r.h for r in documents.selectExpr("text", "xxhash64(text) AS h").collect()}
    seen, left = set(), {}
    # Rows equal in id and text are one document.
    for key, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]])):
        words, gone = text.split(), set()
        for at in range(len(words) - passages.RUN + 1):
            window = tuple(words[at : at + passages.RUN])
            if window in seen:
                gone.update(range(at, at + passages.RUN))
            seen.add(window)
        left[key, text] = [word for at, word in enumerate(words) if at not in gone]
    found = line_chunks.cut_passages(documents).selectExpr("row.doc_id", "row.text", "kept_text").collect()
    assert sorted(r.text for r in found) == sorted(text for _, text in rows)
    assert all(r.kept_text.split() == left[r.doc_id, r.text] for r in found)
    assert sum(len(text.split()) for _, text in set(rows)) > sum(map(len, left.values())) + 1000
