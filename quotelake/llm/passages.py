"""Passages of ``RUN`` words or more that occur again, wherever in a line they stand.

A window is ``RUN`` words in a row, with the white space between them. A window goes if an
equal one stands earlier (by ``doc_id``, then place in the text); of a document all words of
such windows go, so runs of any length are met whole and the first occurrence stays.

Windows are not compared one by one. The least hash of the runs of ``GRAM`` words in a window,
the leftmost if there are several, is its anchor: it depends on the window alone, so equal
windows have equal anchors at equal places in them, and windows in a row with one anchor, a
stretch, are one row. Stretches whose anchor occurs once never leave the first pass. A stretch
that occurred before goes whole. Of the first occurrences of stretches that share an anchor
with other ones, windows are told by their place around the anchor in blocks of ``BLOCK``; the
windows of a block share a core of ``CORE`` words, and only blocks whose core another such
stretch has as well are read window by window. Hashes of anchors and cores only propose;
stretches and windows are equal if their 128-bit BLAKE2b digests are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import map_arrow, slices
from quotelake.session import staged

RUN = 50
GRAM = 12
BLOCK = 10
CORE = RUN - BLOCK + 1
# Texts up to so many bytes are cut together; a longer one is cut alone.
TOGETHER = 1 << 18

_GRAMS = RUN - GRAM + 1
_BLOCKS = -(-_GRAMS // BLOCK)
# A core's hash in a stretch's row, which holds those of all its blocks.
_CORE_BITS = 64 // _BLOCKS
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
# For bytes.translate: 1 for white space.
_IS_WHITE = _WHITE.tobytes()
_RANDOM = np.random.default_rng(0x51)
_BYTE = _RANDOM.integers(1, 1 << 64, 256, dtype=np.uint64)
_BYTE[_WHITE] = 0
# A run's place, in the low half of what the least is taken of.
_PLACE = np.uint64(32)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


class Stretch(NamedTuple):
    anchor: int
    at: int
    """Number of its first word in the text."""
    n: int
    """Windows in it."""
    content: bytes


class Stretches(NamedTuple):
    """Stretches of several texts, a row each."""

    text: np.ndarray
    """Number of the text."""
    anchor: np.ndarray
    at: np.ndarray
    n: np.ndarray
    back: np.ndarray
    """Words from the stretch's first to its anchor."""
    cores: np.ndarray
    start: np.ndarray
    end: np.ndarray
    """Where it lies in the joined texts."""


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``text`` start and end."""
    white = np.ones(len(text) + 2, bool)
    white[1:-1] = np.frombuffer(text.translate(_IS_WHITE), bool)
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[::2].copy(), edges[1::2].copy()


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``_BASE`` and of its inverse, 2 ** ``bits`` of each."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(1 << bits, base, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors))
    return made[0], made[1]


def _word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials in ``_BASE`` over the words' bytes, by sums over the text up to the words."""
    data = np.frombuffer(text, np.uint8)
    found = np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), 1 << 17):
        first, last = starts[low : low + (1 << 17)], ends[low : low + (1 << 17)]
        part = data[first[0] : last[-1]]
        powers, inverses = _powers(int(len(part)).bit_length())
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * powers[: len(part)], out=sums[1:])
        heads = first - first[0]
        found[low : low + len(first)] = (sums[last - first[0]] - sums[heads]) * inverses[heads]
    return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _FACTOR
    return values ^ (values >> np.uint64(29))


def _run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, made of those of runs of 1, 2, 4, ... words."""
    power = lambda n: np.uint64(pow(int(_FACTOR), n, 1 << 64))
    part, size, total, length = words, 1, None, 0
    while True:
        if width & size:
            length += size
            count = len(words) - length + 1
            total = part if total is None else part[:count] * power(length - size) + total[size : size + count]
        if 2 * size > width:
            return _mixed(total)
        part = part[:-size] * power(size) + part[size:]
        size *= 2


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each run of ``width`` values stands first, by their upper halves."""
    least = (values >> _PLACE << _PLACE) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[step:], least[:-step])
        size += step
    return (least & np.uint64((1 << 32) - 1)).view(np.int64)


def cut(joined: bytes, heads: np.ndarray, words: tuple[np.ndarray, np.ndarray] | None = None) -> Stretches:
    """The stretches of texts joined by new lines, which begin at ``heads``; the stretches'
    windows are all windows of the texts. ``words``: their bounds, if known."""
    starts, ends = words or word_bounds(joined)
    if len(starts) < RUN:
        return Stretches(*(np.zeros(0, np.int64) for _ in Stretches._fields))
    first_word = np.searchsorted(starts, heads)
    owner = np.repeat(np.arange(len(heads)), np.diff(first_word, append=len(starts)))
    hashes = _word_hashes(joined, starts, ends)
    grams = _run_hashes(hashes, GRAM)
    places = _first_least(grams, _GRAMS)
    cores = _run_hashes(hashes, CORE) >> np.uint64(64 - _CORE_BITS)
    whole = owner[: len(places)] == owner[RUN - 1 :]
    change = np.ones(len(places) + 1, bool)
    change[1:-1] = (places[1:] != places[:-1]) | (whole[1:] != whole[:-1])
    bounds = np.flatnonzero(change)
    low, high = bounds[:-1], bounds[1:]
    low, high = low[whole[low]], high[whole[low]]
    text, place = owner[low], places[low]
    held = np.zeros(len(low), np.uint64)
    for block in range(_BLOCKS):
        # The core of a block that the stretch has lies in the text; others are not read.
        core = cores[np.clip(place - block * BLOCK, 0, len(cores) - 1)]
        held |= core << np.uint64(block * _CORE_BITS)
    return Stretches(
        text, grams[place].view(np.int64), low - first_word[text], high - low, place - low, held.view(np.int64),
        starts[low], ends[high + RUN - 2],
    )


def joined_texts(texts: Sequence[bytes]) -> tuple[bytes, np.ndarray]:
    return b"\n".join(texts), np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])


def stretches(texts: list[bytes]) -> Iterator[list[Stretch]]:
    """The stretches of each text with their bytes."""
    joined, heads = joined_texts(texts)
    found: list[list[Stretch]] = [[] for _ in texts]
    made = cut(joined, heads)
    columns = (made.text, made.anchor, made.at, made.n, made.start, made.end)
    for text, anchor, at, n, start, end in zip(*(c.tolist() for c in columns)):
        found[text].append(Stretch(anchor, at, n, joined[start:end]))
    yield from found


def repeats(made: Stretches, h: np.ndarray) -> np.ndarray:
    """Whether a stretch with digest ``h`` stands earlier in the same text."""
    return repeated(made.text, h)


def repeated(text: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Of rows in order of place, whether the digest ``h`` stands earlier in the same text."""
    order = np.lexsort((h[:, 1], h[:, 0], text))
    text, h = text[order], h[order]
    again = np.zeros(len(order), bool)
    again[order[1:]] = (text[1:] == text[:-1]) & (h[1:] == h[:-1]).all(1)
    return again


def digests(text: bytes, bounds: Iterable[tuple[int, int]]) -> np.ndarray:
    """128-bit digests of parts of ``text``, as two columns."""
    made = b"".join([blake2b(text[start:end], digest_size=16).digest() for start, end in bounds])
    return np.frombuffer(made, "<i8").reshape(-1, 2)


def spans(text: bytes, runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans of the words of the windows ``at`` to ``at + n - 1``, merged. White space
    after a span goes too, but not the end of a line that had other words before it."""
    starts, ends = word_bounds(text)
    merged: list[list[int]] = []
    for at, n in sorted(runs):
        last = at + n + RUN - 2
        if merged and at <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([at, last])
    found = []
    for at, last in merged:
        start, end = int(starts[at]), int(ends[last])
        after = int(starts[last + 1]) if last + 1 < len(starts) else len(text)
        if start == 0 or text[start - 1 : start] == b"\n" or b"\n" not in text[end:after]:
            end = after
        found.append((start, end))
    return found


def together(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in groups whose texts, the last column, have about ``TOGETHER`` bytes at most."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[-1]) > TOGETHER:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[-1])
    if held:
        yield held


def _batch(columns: Iterable[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# A row with ``again`` holds stretches in a row that all stand earlier in the same text, so they
# go, and the earlier ones meet what is equal to them elsewhere.
STRETCHES = pa.schema([
    *((name, pa.int64()) for name in ("a", "h1", "h2", "k_id", "k_text", "cores")),
    *((name, pa.int32()) for name in ("at", "n", "back")), ("again", pa.bool_()),
])


def stretch_rows(
    joined: bytes, heads: np.ndarray, words: tuple[np.ndarray, np.ndarray], keys: list[np.ndarray]
) -> pa.RecordBatch:
    """Rows of the stretches of joined texts, which ``keys`` name."""
    made = cut(joined, heads, words)
    h = digests(joined, zip(made.start.tolist(), made.end.tolist()))
    again = repeats(made, h)
    # Of repeats in a row the first one's row stands for all.
    follows = again[1:] & again[:-1] & (made.text[1:] == made.text[:-1])
    one = np.flatnonzero(np.concatenate(([True], ~follows))[: len(again)])
    n = np.add.reduceat(made.n, one) if len(one) else made.n
    columns = (made.anchor, h[:, 0], h[:, 1], *(key[made.text] for key in keys), made.cores, made.at)
    return _batch((*(c[one] for c in columns), n, made.back[one], again[one]), STRETCHES)


def runs(found: DataFrame, place: Column) -> DataFrame:
    """Of rows of stretches, per document an array of its stretches that go whole, and of the
    windows in a row that must be read (``check``). ``place`` orders the documents; of a document
    each stretch is met once."""
    # What stands earlier in its text has that one's anchor, so it is a hit.
    hits = _hits(found)
    again = hits.where("again").select("k_id", "k_text", F.struct("at", "n", F.lit(False).alias("check")).alias("run"))
    again = staged(again, "passage-again")
    hits = hits.where("NOT again").drop("again")
    firsts = hits.groupBy("a", "h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.max("varied").alias("varied")
    ).where("varied OR first <> last").select("a", "h1", "h2", "first")
    firsts = staged(firsts, "passage-firsts").hint("shuffle_hash")
    marked = hits.join(firsts, ["a", "h1", "h2"]).select(
        "a", "k_id", "k_text", "at", "n", "back", "cores", (F.col("first") == place).alias("check"), "varied"
    ).where("varied OR NOT check").drop("varied")
    marked = staged(marked, "passage-marked")
    whole = marked.where("NOT check").select("k_id", "k_text", F.struct("at", "n", "check").alias("run"))
    found = whole.unionByName(again).unionByName(_shared_blocks(marked.where("check")))
    return found.groupBy("k_id", "k_text").agg(F.collect_set("run").alias("runs"))


def _shared_blocks(firsts: DataFrame) -> DataFrame:
    """The windows of first occurrences, in blocks, whose core several of them have."""
    blocks = firsts.selectExpr(
        "*", f"explode(sequence(int((back - n + 1) div {BLOCK}), int(back div {BLOCK}))) AS block"
    ).selectExpr(
        "a", "block", f"shiftrightunsigned(cores, block * {_CORE_BITS}) & {(1 << _CORE_BITS) - 1}L AS core", "k_id", "k_text",
        "at + back AS anchor_at", f"least(block * {BLOCK} + {BLOCK - 1}, back) AS far",
        f"greatest(block * {BLOCK}, back - n + 1) AS near",
    )
    # Equal rows of one document are one occurrence.
    place = ["k_id", "k_text", "anchor_at"]
    shared = blocks.groupBy("a", "block", "core").agg(
        *(least(name).alias(f"{least.__name__}_{name}") for name in place for least in (F.min, F.max))
    ).where(" OR ".join(f"min_{name} <> max_{name}" for name in place)).select("a", "block", "core").hint("shuffle_hash")
    return blocks.join(shared, ["a", "block", "core"], "left_semi").selectExpr(
        "k_id", "k_text", "named_struct('at', anchor_at - far, 'n', far - near + 1, 'check', true) AS run"
    )


def _hits(found: DataFrame) -> DataFrame:
    """The stretches whose anchor occurs again."""
    # Copies meet map-side, so a common anchor leaves each task once.
    anchors = found.groupBy("a").agg(
        F.count("*").alias("c"), F.min("h1").alias("low"), F.max("h1").alias("high"),
        F.min("h2").alias("low2"), F.max("h2").alias("high2"),
    ).where("c > 1").selectExpr("a", "low <> high OR low2 <> high2 AS varied")
    return staged(found.join(staged(anchors, "passage-anchors").hint("shuffle_hash"), "a"), "passage-hits")


def later_windows(rows: DataFrame, place: Column) -> DataFrame:
    """Of rows with ``k_id``, ``k_text``, ``text`` and ``runs``, per document an array of the
    windows, in the stretches to check, that stand earlier in another such stretch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *((name, pa.int64()) for name in ("h1", "h2", "k_id", "k_text")), ("at", pa.int32()), ("again", pa.bool_()),
        ])
        for batch in slices(batches, 128):
            made = []
            for k_id, k_text, text, found, counts in zip(*(batch.column(k).to_pylist() for k in range(5))):
                starts, ends = word_bounds(text)
                at = np.unique(np.concatenate([np.arange(first, first + n) for first, n in zip(found, counts)]))
                h = digests(text, zip(starts[at].tolist(), ends[at + RUN - 1].tolist()))
                keys = (np.full(len(at), key, np.int64) for key in (k_id, k_text))
                made.append((h[:, 0], h[:, 1], *keys, at, repeated(np.zeros(len(at), np.int64), h)))
            yield _batch(map(np.concatenate, zip(*made)), schema)

    check = "filter(runs, r -> r.check)"
    rows = rows.where("exists(runs, r -> r.check)")
    rows = rows.selectExpr("k_id", "k_text", "cast(text AS binary)", f"{check}.at AS found", f"{check}.n AS counts")
    schema = "h1 bigint, h2 bigint, k_id bigint, k_text bigint, at int, again boolean"
    found = staged(map_arrow(rows, read, schema), "passage-windows")
    firsts = found.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.max("again").alias("twice")
    ).where("twice OR first <> last").select("h1", "h2", "first")
    firsts = staged(firsts, "passage-first-windows").hint("shuffle_hash")
    later = found.join(firsts, ["h1", "h2"]).where(F.col("again") | (F.col("first") != place))
    return later.groupBy("k_id", "k_text").agg(F.collect_set("at").alias("later"))
