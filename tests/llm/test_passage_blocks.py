"""Windows that nobody else can have are not read one by one; quick cuts equal plain ones."""

from __future__ import annotations

import random
import re

from quotelake.llm import line_chunks, passages


def test_windows_around_a_changed_word_are_not_read(spark, monkeypatch):
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    texts = [(0, " ".join(base))]
    for k in range(1, 20):
        near = list(base)
        near[100 + 10 * k] += "x"
        texts.append((k, " ".join(near)))
    read = []

    def staged(rows, purpose, stage=passages.staged):
        stored = stage(rows, purpose)
        if purpose == "passage-windows":
            read.append(stored.groupBy("h1", "h2").count().where("count = 1").count())
        return stored

    monkeypatch.setattr(passages, "staged", staged)
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: r.removed for r in line_chunks.dedup_passages(documents).collect()}
    # Of each near copy, all words beside the changed one lie in windows that stand earlier.
    assert [len(found[k]) for k in range(20)] == [0] + [2] * 19
    # 50 windows of each near copy hold its changed word and stand nowhere else.
    assert read[0] < 19 * 15, read


def test_sentences_are_cut_as_by_the_plain_rule():
    plain = re.compile(rb".*?[.!?](?:[\x20\x09]+|\n|$)|.+?$", re.DOTALL)
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choices("ab \n.!?\t\r", weights=[8, 8, 12, 1, 2, 1, 1, 1, 0.4], k=rng.randint(0, 200))).encode()
        expected = []
        for line in re.findall(rb"[^\n]*\n|[^\n]+", text):
            expected += plain.findall(line) if len(line.split()) > line_chunks.LONG_LINE else [line]
        assert line_chunks.units(text) == expected
        assert b"".join(text[start:end] for start, end, _ in line_chunks.chunk_spans(text)) == text


def test_repeats_within_a_text_go_in_runs():
    text = b" ".join(b"w%d" % (k % 60) for k in range(400))
    made = passages.cut(text, passages.np.array([0]))
    h = passages.digests(text, zip(made.start.tolist(), made.end.tolist()))
    again = passages.repeats(made, h)
    seen, expected = set(), []
    for start, end in zip(made.start.tolist(), made.end.tolist()):
        expected.append(text[start:end] in seen)
        seen.add(text[start:end])
    assert again.tolist() == expected and sum(expected) > len(expected) // 2
