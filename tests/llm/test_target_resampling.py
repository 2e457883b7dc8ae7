"""Importance resampling against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from quotelake.llm import target_resampling as tr

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]
SCHEMA = "doc_id long, text string, n_words int, found string, fit int, rank string, number int"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, longest, buckets):
    words = words_of(text)
    return [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets
        for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def brute(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    s = Counter(b for _, text in rows for b in features(text, longest, buckets))
    t = Counter(b for text in target for b in features(text, longest, buckets))
    all_s, all_t = s.total(), t.total()
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc_id, text in rows:
        own = features(text, longest, buckets)
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(words_of(text)) >= least])
    fit = sorted((row for row in out if row[5]), key=lambda row: (-row[3], row[0] is not None, row[0] or 0))
    for place, row in enumerate(fit[: len(fit) * percent // 100]):
        row[4] = place + 1
    return sorted((tuple(row[:5]) for row in out), key=repr)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    words = ["the", "of", "Data", "model", "été", "ÀÉ", "x1", "漢字", "a" * 90, *(f"w{k}" for k in range(300))]
    marks = [" ", " ", ", ", "\n", "--", "\x00", "'", "_"]

    def text(n):
        return "".join(rng.choice(words[: rng.choice((5, 60, len(words)))]) + rng.choice(marks) for _ in range(n))

    rows = [(n, text(rng.choice((0, 1, 19, 20, 21, 60)))) for n in range(250)]
    rows += [(1000, None), (1001, ""), (1002, ". ,"), (1003, text(30_000)), (None, text(40)), (1004, rows[30][1]), (1004, rows[30][1])]
    return rows, [text(25) for _ in range(20)] + [None, ""]


def frames(spark, pairs):
    rows, target = pairs
    documents = spark.createDataFrame([(d, t, 1, "f", 2, "r", 3) for d, t in rows], SCHEMA).repartition(4)
    return documents, spark.createDataFrame([(n, t) for n, t in enumerate(target)], "item_id long, text string")


@pytest.mark.parametrize("longest, head", [(1, tr.HEAD), (1, 3), (2, tr.HEAD), (2, 4), (3, 7)])
def test_against_plain_loops(spark, pairs, longest, head):
    """The size of the head changes nothing."""
    found = tr.resample(*frames(spark, pairs), longest=longest, head=head, percent=30)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == brute(*pairs, longest=longest, percent=30)


def test_few_buckets_and_all_drawn(spark, pairs):
    found = tr.resample(*frames(spark, pairs), buckets=7, percent=100, least_words=0, seed=5)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(*pairs, buckets=7, percent=100, least=0, seed=5)


def test_empty_tables(spark, pairs):
    documents, target = frames(spark, pairs)
    assert tr.resample(documents.limit(0), target).collect() == []
    found = tr.resample(documents, target.limit(0)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(pairs[0], [])


def test_frequent_words_and_pairs_are_in_the_head(spark, pairs):
    documents, _ = frames(spark, pairs)
    words, both = tr.head_of(documents, 2, 12)
    assert len(words) <= 12 and len(both) <= 12 and all(len(word) <= tr.LONG for word in words)
    assert {b"the", b"of", b"data"} <= set(words)
    assert all(state == zlib.crc32(word) for word, state in words.items())
    assert all(state == zlib.crc32(b" ".join(pair)) for pair, state in both.items())


def test_a_summary_never_loses_a_heavy_key():
    rng, summary, truth = random.Random(1), tr.Summary(20), Counter()
    for _ in range(50):
        fresh = Counter(rng.choice((b"hot", b"warm", str(rng.randrange(10_000)).encode())) for _ in range(400))
        summary.add(fresh)
        truth += fresh
    summary.shrink()
    assert len(summary.counts) <= 20
    for key in (b"hot", b"warm"):
        assert truth[key] - truth.total() // 20 <= summary.counts[key] <= truth[key]


def test_drawn_documents_keep_their_columns(spark, pairs):
    documents, target = frames(spark, pairs)
    drawn = tr.drawn_documents(documents, target, percent=30)
    assert drawn.columns == documents.columns
    wanted = {row[0] for row in brute(*pairs, percent=30) if row[4] and row[0] is not None}
    assert {row["doc_id"] for row in drawn.collect()} == wanted
