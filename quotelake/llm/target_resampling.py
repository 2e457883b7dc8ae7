"""Importance resampling towards a target distribution over hashed n-gram features.

A text is lower-cased in A-Z and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Its
features are all runs of 1 to ``longest`` words joined by one space; a feature's bucket is its
CRC-32 modulo ``buckets``. From the exact totals of both corpora every bucket gets a gain,
``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))``, and a document the sum of its features' gains.
Documents with enough words are drawn without repeats by highest weight plus Gumbel noise.

Head and tail: a first pass counts words (and pairs of frequent words). Each task keeps a
summary of at most ``HEAD`` counters, from which a word that has more than one ``HEAD``-th of
the task's words is never lost. The heaviest words become the head and go to every task as a
table of at most ``HEAD`` words with the exact CRC state after them, frequent pairs with the
state and thereby the bucket of the pair. A head word costs one look-up, and a longer run
continues from the state of its first words; anything else takes its CRC directly. Both give
the same CRC, so the head decides on speed only, never on a bucket.

Bucket numbers are written once per document. Totals are summed per task and then exchanged
as one row per bucket and task; gains are one array of ``buckets`` numbers. The drawn
documents are numbered by ``numbered``, so no task sorts them all.

Nulls and edges: a null text or one without words has no features and weight 0. ``doc_id`` null
is hashed as the empty text and comes first among ties. Repeated rows are documents of their
own. A text shorter than a run has no such run. An empty target or an empty table is fine:
totals of 0. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import map_arrow, slices
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.operators.numbering import numbered
from quotelake.session import staged

LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Words of a task's summary, words of the head, pairs of the head: about 10 MB each at most.
HEAD = 65_536
# Bytes of the longest key of a head.
LONG = 64

# Everything but digits, lower-case letters and bytes of other characters parts words.
_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)).translate(_BYTES)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


class Head(dict):
    """CRC states by word; a word outside the head takes its CRC directly and is not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Summary:
    """Heaviest keys of a stream by Misra and Gries: a count falls short of the truth by at
    most one ``size``-th of all entries."""

    def __init__(self, size: int = HEAD):
        self.size, self.counts = size, Counter()

    def add(self, counted: Counter) -> None:
        self.counts.update(counted)
        if len(self.counts) > 4 * self.size:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.size:
            less = np.partition(np.fromiter(self.counts.values(), np.int64), -self.size - 1)[-self.size - 1]
            self.counts = Counter({key: n - int(less) for key, n in self.counts.items() if n > less})


def _heaviest(texts: DataFrame, keys, size: int) -> list[tuple[bytes, ...]]:
    """The keys with the largest counts, ``size`` at most. ``keys`` gives the keys (tuples of
    words) of a list of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in slices(batches):
            fresh = Counter()
            for text in batch.column(0).to_pylist():
                fresh.update(keys(words_of(text)))
            summary.add(Counter({b" ".join(key) if isinstance(key, tuple) else key: n for key, n in fresh.items()}))
        summary.shrink()
        # A long word would make the head large and is seldom frequent; its CRC is taken directly.
        found = [key for key in summary.counts if len(key) <= LONG]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array(map(summary.counts.get, found), pa.int64())], ["key", "n"]
        )

    counted = map_arrow(texts.select("text"), count, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    # A key seen once spares nothing.
    top = counted.where("n > 1").orderBy(F.desc("n"), "key").limit(size).select("key").collect()
    return [tuple(bytes(row["key"]).split(b" ")) for row in top]


def head_of(texts: DataFrame, longest: int = LONGEST, size: int = HEAD) -> tuple[dict, dict]:
    """CRC states of frequent words and, for longer runs, of frequent pairs."""
    words = {key[0]: zlib.crc32(key[0]) for key in _heaviest(texts, lambda found: found, size)}
    if longest < 2:
        return words, {}

    def pairs(found: list[bytes]) -> list[tuple[bytes, bytes]]:
        return [pair for pair in pairwise(found) if pair[0] in words and pair[1] in words]

    return words, {key: zlib.crc32(b" " + key[1], words[key[0]]) for key in _heaviest(texts, pairs, size)}


def states_of(words: list[bytes], longest: int, head: Head, pairs: dict) -> list[int]:
    """The CRC of every feature: runs of one word first, then of two, and so on."""
    states = last = list(map(head.__getitem__, words))
    for length in range(2, longest + 1):
        following = zip(last, words[length - 1 :])
        if length == 2 and pairs:
            found = map(pairs.get, pairwise(words))
            last = [zlib.crc32(b" " + word, state) if known is None else known
                    for known, (state, word) in zip(found, following)]
        else:
            last = [zlib.crc32(b" " + word, state) for state, word in following]
        states = states + last
    return states


def bucketed(documents: DataFrame, head: tuple[dict, dict], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``found``, the bucket of every feature as
    little-endian unsigned 32-bit numbers."""
    broadcast = documents.sparkSession.sparkContext.broadcast(head)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, pairs = Head(broadcast.value[0]), broadcast.value[1]
        for batch in slices(batches):
            sizes, counts, found = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                states = np.array(states_of(words, longest, head, pairs), dtype=np.uint32)
                sizes.append(len(words))
                counts.append(len(states))
                found.append((states % np.uint32(buckets)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(found, pa.binary())],
                ["doc_id", "n_words", "n_features", "found"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, encode, "doc_id bigint, n_words bigint, n_features bigint, found binary")


def totals(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``, how many features are in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            joined = b"".join(batch.column(0).to_pylist())
            held += np.bincount(np.frombuffer(joined, "<u4"), minlength=buckets)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(held[seen])], ["bucket", "n"])

    counted = map_arrow(found.select("found"), count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket; both totals have one row per bucket at most."""
    s, t = [0] * buckets, [0] * buckets
    for counts, rows in ((s, raw), (t, target)):
        for row in rows.collect():
            counts[row["bucket"]] = row["n"]
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array(
        [floor(1000 * log(float(b + 1) * all_s / (float(a + 1) * all_t))) for a, b in zip(s, t)], dtype=np.int64
    )


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            weights = [int(gain[np.frombuffer(ids, "<u4")].sum()) for ids in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(weights, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    rows = found.select("doc_id", "n_words", "n_features", "found")
    return map_arrow(rows, weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    documents: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, head: int = HEAD,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn) of every row."""
    known = head_of(documents, longest, head)
    found = staged(bucketed(documents, known, longest, buckets), "resampling-buckets")
    wanted = bucketed(target.select(F.lit(None).alias("doc_id"), "text"), known, longest, buckets)
    gain = gains(totals(found, buckets), totals(wanted, buckets), buckets)
    h = f"bigint(conv(substring(sha2(concat('{seed}:', coalesce(string(doc_id), '')), 256), 1, 8), 16, 10))"
    scored = weighed(found, gain).selectExpr(
        "*", f"weight + bigint(floor(-1000D * ln(-ln(({h} + 0.5D) / 4294967296D)))) AS score",
        f"n_words >= {least_words} AS fit",
    )
    scored = staged(scored, "resampling-scores")
    drawn = scored.where("fit").count() * percent // 100
    order = [F.desc("fit"), F.desc("score"), F.asc("doc_id")]
    return numbered(scored, order, "number").selectExpr(
        "doc_id", "n_features", "weight", "score", f"CASE WHEN number < {drawn} THEN number + 1 END AS rank"
    )


def drawn_documents(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents in their own columns. Rows of one ``doc_id`` are drawn together."""
    ids = resample(documents, target, **options).where("rank IS NOT NULL AND doc_id IS NOT NULL")
    ids = staged(ids.select(F.col("doc_id").alias("drawn_id")).distinct(), "resampling-drawn")
    ids = broadcast_if(fits(ids, 200_000), ids)
    return documents.join(ids, documents["doc_id"].cast("bigint") == ids["drawn_id"], "left_semi")
