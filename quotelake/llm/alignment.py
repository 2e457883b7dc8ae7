"""Cross-tokenizer alignment by an associative monoid of fragments.

A text gets tokens of tokenizer A (byte-level BPE over space + text) and B (pieces with a
leading space). Byte offsets at which a token of A and one of B end together cut both into
groups; the two tokens that end there are a link.

A text of at least two chunks is cut into ranges of about ``CHUNK`` characters, which any
task may take. Each tokenizer is cut where its own tokens can never span, so the ranges of A
and B differ at their edges, and a chunk's first and last tokens wait for their partners. A
chunk is a ``Fragment``: an open prefix (tokens up to the first common end), closed groups and
an open suffix. ``joined`` composes two neighbours: what was open between them is cut at its
common ends. It is associative, because a common end is known as soon as both tokens are, and
all common ends between two known ones of a fragment are known. Fragments of a document are
composed in a tree of ``FAN`` neighbours a level, over Spark tasks, until one is left.

An id pair counts how many links of the corpus hold it. Counts are summed per task before the
exchange. Per document they are looked up in two ways: frequent pairs, ``HEAD`` at most, in a
table that every task holds; the others by a shuffle join, whose keys are then all rare.

Nulls and edges: a null or empty text, and one whose joined token bytes of A or B differ from
space + text (say, one that holds U+2581), has no tokens: zeros and an empty hash column. A
null ``doc_id`` is kept. Repeated rows are documents of their own. A text without a place to
cut is one chunk. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import map_arrow, partitions, slices
from quotelake.session import staged

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 16_384
FAN = 4
# Pairs that every task holds, 13 bytes each.
HEAD = 500_000

SPACE = "▁"
# A never has a token over the edge from other characters to white space, B none to a blank.
_CUT_A = re.compile(r"(?<=\S)[ \t\n\r]")
_CUT_B = re.compile(r"(?<=[^ ]) (?=.)", re.DOTALL)
# Characters on whose classes all tools agree; texts with others take the slower encoder.
_UNUSUAL = re.compile("[^\x00-ԯ‐-‧‰-⁞€]")


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 bytes stand
    for themselves, the others for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + place): byte for place, byte in enumerate(rest)}


class ByteTokens:
    """Tokenizer A and the bytes of its tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        special = {token.content for token in self.slow.get_added_tokens_decoder().values()}
        self.bytes: list[bytes] = [b""] * self.slow.get_vocab_size()
        for token, number in vocabulary.items():
            self.bytes[number] = token.encode() if token in special else bytes(map(letters.__getitem__, token))
        self.sizes = np.array(list(map(len, self.bytes)), dtype=np.int64)
        self.quick = None
        made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        if made == sorted(made):
            # Ids follow the order of merges, so they are ranks and the faster encoder gives the same ids.
            import tiktoken

            ranks = {self.bytes[number]: number for token, number in vocabulary.items() if token not in special}
            self.quick = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.quick and len(text) <= 4 * CHUNK and not _UNUSUAL.search(text):
            return self.quick.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Tokenizer B and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(number) for number in numbers]
        self.bytes = [
            bytes([int(piece[1:-1], 16)]) if self.model.is_byte(number) else piece.replace(SPACE, " ").encode()
            for number, piece in enumerate(pieces)
        ]
        self.sizes = np.array(list(map(len, self.bytes)), dtype=np.int64)
        # Cutting before a blank needs that no piece has one after another character.
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces):
            raise ValueError(f"{path} has pieces that go on after a blank")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """``texts`` begin with the blank that the tokenizer itself adds."""
        return self.model.encode([text[1:] for text in texts], num_threads=1) if texts else []


_made: dict[tuple[type, str], object] = {}


def _once(kind: type, path: str):
    """A worker's tokenizer, kept from task to task."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]


class Tokens(NamedTuple):
    """Consecutive tokens of both sides: ids and the offsets at which they end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(both) for both in zip(self, other)))

    def part(self, a: slice, b: slice) -> Tokens:
        return Tokens(self.a[a], self.a_ends[a], self.b[b], self.b_ends[b])

    def ends(self) -> np.ndarray:
        """The common ends, in order."""
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)


def none() -> Tokens:
    empty = np.zeros(0, np.int64)
    return Tokens(empty, empty, empty, empty)


class Closed(NamedTuple):
    """Closed groups: their text and one link (ids of A and B in 32 bits) each."""

    text: bytes
    links: np.ndarray

    def __add__(self, other: Closed) -> Closed:
        text = self.text + b";" + other.text if self.text and other.text else self.text or other.text
        return Closed(text, np.concatenate([self.links, other.links]))


NO_GROUPS = Closed(b"", np.zeros(0, np.uint32))
# A number and what follows it: the next of its side, the other side, the next group.
_WRITTEN = [f"{number}{mark}" for number in range(1 << 16) for mark in ",|;"]


def closed(tokens: Tokens, ends: np.ndarray) -> Closed:
    """The groups of ``tokens``, which end at ``ends``."""
    if not len(ends):
        return NO_GROUPS
    last_a, last_b = np.searchsorted(tokens.a_ends, ends), np.searchsorted(tokens.b_ends, ends)
    mark_a, mark_b = np.zeros(len(tokens.a), np.int64), np.zeros(len(tokens.b), np.int64)
    mark_a[last_a], mark_b[last_b] = 1, 2
    # A token's place: its own side's tokens before it, and the other side's of whole groups.
    place_a = np.arange(len(tokens.a)) + np.concatenate([[0], last_b + 1])[np.searchsorted(ends, tokens.a_ends)]
    place_b = np.arange(len(tokens.b)) + (last_a + 1)[np.searchsorted(ends, tokens.b_ends)]
    order = np.empty(len(place_a) + len(place_b), np.int64)
    order[place_a], order[place_b] = tokens.a * 3 + mark_a, tokens.b * 3 + mark_b
    text = "".join(map(_WRITTEN.__getitem__, order.tolist()))[:-1]
    links = tokens.a[last_a].astype(np.uint32) << np.uint32(16) | tokens.b[last_b].astype(np.uint32)
    return Closed(text.encode(), links)


class Fragment(NamedTuple):
    """Tokens of a range. Without a common end all are in ``prefix`` and ``met`` is false."""

    met: bool
    prefix: Tokens
    groups: Closed
    suffix: Tokens
    n_a: int
    n_b: int


def fragment(tokens: Tokens) -> Fragment:
    return _opened(tokens, len(tokens.a), len(tokens.b))


def _opened(tokens: Tokens, n_a: int, n_b: int) -> Fragment:
    ends = tokens.ends()
    if not len(ends):
        return Fragment(False, tokens, NO_GROUPS, none(), n_a, n_b)
    first = tokens.part(*_until(tokens, ends[0]))
    rest = tokens.part(*_after(tokens, ends[0]))
    inner = rest.part(*_until(rest, ends[-1]))
    return Fragment(True, first, closed(inner, ends[1:]), tokens.part(*_after(tokens, ends[-1])), n_a, n_b)


def _until(tokens: Tokens, end: int) -> tuple[slice, slice]:
    return slice(np.searchsorted(tokens.a_ends, end, "right")), slice(np.searchsorted(tokens.b_ends, end, "right"))


def _after(tokens: Tokens, end: int) -> tuple[slice, slice]:
    a, b = _until(tokens, end)
    return slice(a.stop, None), slice(b.stop, None)


def joined(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    n_a, n_b = left.n_a + right.n_a, left.n_b + right.n_b
    if not left.met:
        whole = _opened(left.prefix + right.prefix, n_a, n_b)
        return whole._replace(groups=whole.groups + right.groups, suffix=right.suffix) if right.met else whole
    between = left.suffix + right.prefix
    ends = between.ends()
    cut = ends[-1] if len(ends) else -1
    groups = left.groups + closed(between.part(*_until(between, cut)), ends) + right.groups
    suffix = right.suffix if right.met else between.part(*_after(between, cut))
    return Fragment(True, left.prefix, groups, suffix, n_a, n_b)


def finished(whole: Fragment) -> Closed:
    """All groups of a whole document, whose first one is the prefix."""
    return closed(whole.prefix, whole.prefix.ends()) + whole.groups


# Fragments in Arrow

FRAGMENT = (
    "row bigint, doc_id bigint, k bigint, n_chunks bigint, sound boolean, met boolean, n_a bigint, n_b bigint, "
    "open array<binary>, text binary, links binary"
)
_NAMES = ["row", "doc_id", "k", "n_chunks", "sound", "met", "n_a", "n_b", "open", "text", "links"]
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


def _packed(found: Fragment) -> tuple:
    tokens = [part.astype("<i8").tobytes() for part in (*found.prefix, *found.suffix)]
    return found.met, found.n_a, found.n_b, tokens, found.groups.text, found.groups.links.astype("<u4").tobytes()


def _unpacked(met: bool, n_a: int, n_b: int, tokens: list[bytes], text: bytes, links: bytes) -> Fragment:
    parts = [np.frombuffer(part, "<i8") for part in tokens]
    return Fragment(met, Tokens(*parts[:4]), Closed(text, np.frombuffer(links, "<u4")), Tokens(*parts[4:]), n_a, n_b)


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.list_(pa.binary()), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else ([] for _ in types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], _NAMES)


def _aligned_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Final records from (doc_id, sound, n_a, n_b, groups)."""
    out = []
    for doc_id, sound, n_a, n_b, groups in rows:
        if sound and len(groups.links):
            digest = hashlib.sha256(groups.text).hexdigest()
            out.append((doc_id, n_a, n_b, len(groups.links), digest, groups.links.astype("<u4").tobytes()))
        else:
            out.append((doc_id, 0, 0, 0, "", b""))
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    columns = zip(*out) if out else ([] for _ in types)
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


class Ranges(NamedTuple):
    """One chunk's texts and the byte offsets at which they start."""

    a: str
    a_start: int
    b: str
    b_start: int


def chunks(text: str, size: int = CHUNK) -> list[Ranges]:
    """The ranges of space + text."""
    text = " " + text
    count = max(1, len(text) // size)

    def places(cut: re.Pattern) -> list[int]:
        found = [cut.search(text, k * size) for k in range(1, count)]
        return [0, *(hit.start() if hit else len(text) for hit in found), len(text)]

    def parts(at: list[int]) -> list[tuple[str, int]]:
        out, start = [], 0
        for first, last in zip(at, at[1:]):
            out.append((text[first:last], start))
            start += len(text[first:last].encode())
        return out

    return [Ranges(*a, *b) for a, b in zip(parts(places(_CUT_A)), parts(places(_CUT_B)))]


def _tokenized(ranges: list[Ranges], paths: tuple[str, str]) -> Iterator[tuple[bool, Tokens]]:
    """Per chunk, whether both sides' bytes are its text, and its tokens."""
    one, other = _once(ByteTokens, paths[0]), _once(PieceTokens, paths[1])
    pieces = iter(other.encode([each.b for each in ranges if each.b]))
    for each in ranges:
        a = one.encode(each.a) if each.a else []
        b = next(pieces) if each.b else []
        sound = (
            b"".join(map(one.bytes.__getitem__, a)) == each.a.encode()
            and b"".join(map(other.bytes.__getitem__, b)) == each.b.encode()
        )
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        yield sound, Tokens(
            a, np.cumsum(one.sizes[a]) + each.a_start, b, np.cumsum(other.sizes[b]) + each.b_start
        )


def _short(documents: DataFrame, paths: tuple[str, str]) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts = batch.column(1).to_pylist()
            ranges = [Ranges(" " + text, 0, " " + text, 0) if text else Ranges("", 0, "", 0) for text in texts]
            rows = []
            for doc_id, (sound, tokens) in zip(batch.column(0).to_pylist(), _tokenized(ranges, paths)):
                rows.append((doc_id, sound, len(tokens.a), len(tokens.b), closed(tokens, tokens.ends()) if sound else NO_GROUPS))
            yield _aligned_batch(rows)

    return map_arrow(documents, align, ALIGNED)


def _long(documents: DataFrame, paths: tuple[str, str], size: int, fan: int) -> DataFrame:
    """Documents of several chunks: cut, dealt out, tokenized, composed in a tree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row, doc_id, text = (batch.column(k)[0].as_py() for k in range(3))
            found = chunks(text, size)
            for first in range(0, len(found), 16):
                part = found[first : first + 16]
                columns = [[row] * len(part), [doc_id] * len(part), range(first, first + len(part)), [len(found)] * len(part),
                           [p.a for p in part], [p.a_start for p in part], [p.b for p in part], [p.b_start for p in part]]
                types = [*[pa.int64()] * 4, pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)],
                    ["row", "doc_id", "k", "n_chunks", "a", "a_start", "b", "b_start"],
                )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            held = [batch.column(k).to_pylist() for k in range(8)]
            ranges = [Ranges(*each) for each in zip(*held[4:])]
            rows = []
            for row, doc_id, k, n, (sound, tokens) in zip(*held[:4], _tokenized(ranges, paths)):
                met, *rest = _packed(fragment(tokens))
                rows.append((row, doc_id, k, n, sound, met, *rest))
            yield _row_batch(rows)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            rows = []
            for row, k, parts in zip(*(batch.column(c).to_pylist() for c in range(3))):
                whole = None
                for each in parts:
                    found = _unpacked(*(each[name] for name in ("met", "n_a", "n_b", "open", "text", "links")))
                    whole = found if whole is None else joined(whole, found)
                met, *rest = _packed(whole)
                sound = all(each["sound"] for each in parts)
                rows.append((row, parts[0]["doc_id"], k, parts[0]["n_chunks"], sound, met, *rest))
            yield _row_batch(rows)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            entry = {name: batch.column(place)[0].as_py() for place, name in enumerate(_NAMES)}
            whole = _unpacked(*(entry[name] for name in ("met", "n_a", "n_b", "open", "text", "links")))
            yield _aligned_batch([(entry["doc_id"], entry["sound"], whole.n_a, whole.n_b, finished(whole))])

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    dealt = map_arrow(
        rows, cut,
        "row bigint, doc_id bigint, k bigint, n_chunks bigint, a string, a_start bigint, b string, b_start bigint",
    ).repartition(partitions(documents), "row", "k")
    found = staged(map_arrow(dealt, tokenize, FRAGMENT), "alignment-fragments")
    most = found.agg(F.max("n_chunks")).first()[0] or 1
    while most > 1:
        entry = F.struct("k", *(name for name in _NAMES if name not in ("row", "k")))
        level = found.groupBy("row", F.expr(f"k div {fan}").alias("up")).agg(F.sort_array(F.collect_list(entry)).alias("parts"))
        found = staged(map_arrow(level.select("row", "up", "parts"), compose, FRAGMENT), "alignment-level")
        most = -(-most // fan)
    return map_arrow(found, finish, ALIGNED)


def alignments(
    documents: DataFrame, paths: tuple[str, str] | None = None, size: int = CHUNK, fan: int = FAN
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256`` and ``links`` of every row."""
    paths = paths or default_paths()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = f"length(coalesce(text, '')) >= {2 * size}"
    return _short(rows.where(f"NOT {long}"), paths).unionByName(_long(rows.where(long), paths, size, fan))


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links that hold it) and ``best`` (no pair of its B id has more)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches):
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").astype(np.int64)
            fresh, n = np.unique(found, return_counts=True)
            pairs, place = np.unique(np.concatenate([pairs, fresh]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(pairs)).astype(np.int64)
            if len(pairs) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    counted = map_arrow(links.select("links"), count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = staged(counted, "alignment-pairs").withColumn("b", F.expr("pair & 65535"))
    # One row per id of B's vocabulary.
    most = F.broadcast(counted.groupBy("b").agg(F.max("n").alias("most")))
    return staged(counted.join(most, "b").selectExpr("pair", "n", "n = most AS best"), "alignment-counts")


def _head_from(counts: DataFrame, head: int) -> int:
    """The least power of two that at most ``head`` pairs reach with their counts."""
    sizes = counts.groupBy(F.expr("int(floor(log2(n)))").alias("e")).count().collect()
    power, held = 64, 0
    by_power = {row["e"]: row["count"] for row in sizes}
    while power > 0 and held + by_power.get(power - 1, 0) <= head:
        power -= 1
        held += by_power.get(power, 0)
    return 1 << power


def scored(found: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``found`` without ``links``, with ``n_links``, ``n_best`` and ``count_sum``."""
    least = _head_from(counts, head)
    known = counts.where(f"n >= {least}").orderBy("pair").toArrow()
    pairs = known.column("pair").to_numpy().astype(np.uint32)
    held = found.sparkSession.sparkContext.broadcast(
        (pairs, known.column("n").to_numpy(), known.column("best").to_numpy(zero_copy_only=False))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = held.value
        for batch in slices(batches):
            bests, sums, rare, rare_n = [], [], [], []
            for links in batch.column(6).to_pylist():
                links = np.frombuffer(links, "<u4")
                place = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
                there = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
                place = place[there]
                bests.append(int(best[place].sum()))
                sums.append(int(counts[place].sum()))
                left, n = np.unique(links[~there], return_counts=True)
                rare.append(left.astype(np.int64).tolist())
                rare_n.append(n.tolist())
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(6)), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(rare, lists), pa.array(rare_n, lists)],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "rare", "rare_n"],
            )

    rows = map_arrow(
        found.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"), look_up,
        "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint, rare array<bigint>, rare_n array<bigint>",
    )
    if least > 1:
        rows = staged(rows, "alignment-scored")
        left = rows.selectExpr("row", "inline(arrays_zip(rare, rare_n))").withColumnRenamed("rare", "pair")
        met = left.join(counts.where(f"n < {least}"), "pair")
        more = met.groupBy("row").agg(
            F.expr("sum(IF(best, rare_n, 0L))").alias("more_best"), F.expr("sum(rare_n * n)").alias("more_sum")
        )
        rows = rows.join(more, "row", "left").withColumn("n_best", F.expr("n_best + coalesce(more_best, 0L)"))
        rows = rows.withColumn("count_sum", F.expr("count_sum + coalesce(more_sum, 0L)"))
    return rows.selectExpr(
        "doc_id", "n_a", "n_b", "n_groups", "n_groups AS n_links", "n_best", "count_sum", "groups_sha256"
    )


def aligned(
    documents: DataFrame, paths: tuple[str, str] | None = None, size: int = CHUNK, fan: int = FAN, head: int = HEAD
) -> DataFrame:
    """Per row: tokens, groups and links of both tokenizers, and how common its links are."""
    found = alignments(documents, paths, size, fan).withColumn("row", F.monotonically_increasing_id())
    folder = staged(found, "alignment")
    return scored(folder, pair_counts(folder), head)
