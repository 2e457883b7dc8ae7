"""Line dedup by content-defined line chunks.

A text is read as units: its lines, and lines longer than ``LONG_LINE`` words cut after
their sentences. Units are hashed, a rolling hash over the hashes of two units decides
after each unit whether a chunk ends there, so chunks begin and end at the same content
wherever it stands, and an inserted line moves no other chunk. Chunks of at least two units
and ``LEAST_WORDS`` words that occur again anywhere are removed, all but the first
occurrence (by ``doc_id``, then place in the text).

Hashes only propose: what is removed was compared byte by byte. Chunks whose hash occurs
once never leave the first pass, which cuts chunks and passages alike. For the others the texts
are met with their marks once, in one exchange, and equal hashes are grouped with their bytes; a
hash that stands for several byte strings is resolved by the strings themselves. Rows with
nothing marked are stored apart and meet no Python again.

Chunks alone leave most of a passage that starts or ends inside a line. ``dedup_passages``
removes what the chunks remove and every run of ``passages.RUN`` words or more that stands
earlier. Both rules look to an earlier occurrence in the same order, so of all that is removed
one occurrence stays.

Nulls and edges: a null text stays null; a text all of whose chunks are removed is empty;
blank units count as units but not as words; rows without ``doc_id`` come last in the order;
rows equal in id and text are one document, so they lose and keep the same chunks; an empty
table gives no rows. Columns of the documents stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm import passages
from quotelake.llm.common import map_arrow, slices
from quotelake.session import consumed, shared_dir, staged

LONG_LINE = 25
# One boundary in so many units.
DIVISOR = 2
LEAST_UNITS = 2
LEAST_WORDS = 10
MOST_UNITS = 64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
_NEW_LINE = 0x0A
# For bytes.translate: 1 for the marks that end sentences; 1 for white space that no sentence ends in.
_IS_STOP = bytes(k in b".!?" for k in range(256))
_IS_BREAK = bytes(k in b"\n\v\f\r" for k in range(256))
_RUNS = "array<struct<at:int,n:int,check:boolean>>"
# Kinds of stored rows.
_UNMARKED, _MARKED, _CHECKED = range(3)


class Chunk(NamedTuple):
    content: bytes
    units: int
    words: int


class Cuts(NamedTuple):
    """Units, or chunks, of several texts, a row each."""

    text: np.ndarray
    """Number of the text."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    """Number of its first word, and of the first one after it, in the joined texts."""
    after: np.ndarray
    held: np.ndarray
    """Units in it."""
    trimmed: np.ndarray
    """Its end without white space; its start, if it has no word."""


def _cuts(
    text: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, after: np.ndarray, held: np.ndarray,
    word_ends: np.ndarray,
) -> Cuts:
    trimmed = start.copy()
    some = after > first
    trimmed[some] = word_ends[after[some] - 1]
    return Cuts(text, start, end, first, after, held, trimmed)


def _flagged(text: bytes, flags: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(text.translate(flags), bool))


def _in_order(*places: np.ndarray) -> np.ndarray:
    """The places, each once."""
    held = np.sort(np.concatenate(places), kind="stable")
    return held[np.append(True, held[1:] != held[:-1])]


def _sentence_ends(
    joined: bytes, bounds: np.ndarray, long: np.ndarray, starts: np.ndarray, breaks: np.ndarray
) -> np.ndarray:
    """Where the ``long`` of the lines between ``bounds`` are cut: after a mark that blanks
    follow, and the blanks; before the new line at their end, unless a mark stands there."""
    data = np.frombuffer(joined, np.uint8)
    stops = _flagged(joined, _IS_STOP)
    stops = stops[long[np.searchsorted(bounds, stops, "right") - 1]]
    stops = stops[stops + 1 < len(data)]
    follows = data[stops + 1]
    stops = stops[(follows == 0x20) | (follows == 0x09)] + 1
    # The blanks end at a word, at other white space or with the last text.
    ends = np.full(len(stops), len(data))
    for others in (starts, breaks):
        ends = np.minimum(ends, np.append(others, len(data))[np.searchsorted(others, stops)])
    lasts = bounds[1:][long] - 1
    lasts = lasts[data[lasts] == _NEW_LINE]
    before = np.frombuffer(_IS_STOP, bool)[data[lasts - 1]]
    return np.concatenate((ends, lasts[~before]))


def _units(joined: bytes, heads: np.ndarray, words: tuple[np.ndarray, np.ndarray]) -> Cuts:
    """The units of texts joined by new lines, which begin at ``heads``."""
    starts, word_ends = words
    tails = np.append(heads[1:] - 1, len(joined))
    breaks = _flagged(joined, _IS_BREAK)
    lines = breaks[np.frombuffer(joined, np.uint8)[breaks] == _NEW_LINE] + 1
    bounds = _in_order(lines, heads, tails)
    long = np.diff(np.searchsorted(starts, bounds)) > LONG_LINE
    if long.any():
        bounds = _in_order(bounds, _sentence_ends(joined, bounds, long, starts, breaks))
    numbers = np.searchsorted(starts, bounds)
    # What lies between two texts is no unit.
    between = np.zeros(len(bounds), bool)
    between[-1] = True
    between[np.searchsorted(bounds, tails[:-1])] = True
    own = np.flatnonzero(~between)
    text = np.searchsorted(heads, bounds[own], "right") - 1
    held = np.ones(len(own), np.int64)
    return _cuts(text, bounds[own], bounds[own + 1], numbers[own], numbers[own + 1], held, word_ends)


def cut(joined: bytes, heads: np.ndarray, words: tuple[np.ndarray, np.ndarray]) -> Cuts:
    """The chunks of texts joined by new lines, which begin at ``heads``; ``words`` are bounded so.
    A unit's hash leaves out white space at its end, so the last line of a text ends a chunk like
    any other."""
    units = _units(joined, heads, words)
    bounds = zip(units.start.tolist(), units.trimmed.tolist())
    values = b"".join([xxhash.xxh3_64_digest(joined[start:end]) for start, end in bounds])
    values = np.frombuffer(values, ">u8").astype(np.uint64)
    rolling = values.copy()
    rolling[1:] += values[:-1] * _FACTOR
    ends = (rolling ^ (rolling >> _HALF)) % np.uint64(DIVISOR) == 0
    last_units = np.append(units.text[1:] != units.text[:-1], True)[: len(ends)]
    lasts, held = [], 0
    for number, (here, over) in enumerate(zip(ends.tolist(), last_units.tolist())):
        held += 1
        if over or held >= LEAST_UNITS and (here or held >= MOST_UNITS):
            lasts.append(number)
            held = 0
    last = np.array(lasts, np.int64)
    first = np.append(0, last[:-1] + 1)[: len(last)]
    return _cuts(
        units.text[last], units.start[first], units.end[last], units.first[first], units.after[last],
        last - first + 1, words[1],
    )


def spans_of(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[int], list[int]]]:
    """Of each text the starts, the ends, the ends without white space and the numbers of units of
    its chunks."""
    for group in passages.together((text,) for text in texts):
        joined, heads = passages.joined_texts([text for text, in group])
        made = cut(joined, heads, passages.word_bounds(joined))
        firsts = np.searchsorted(made.text, np.arange(len(group) + 1)).tolist()
        for number, head in enumerate(heads.tolist()):
            mine = slice(firsts[number], firsts[number + 1])
            places = ((c[mine] - head).tolist() for c in (made.start, made.end, made.trimmed))
            yield *places, made.held[mine].tolist()


def units(text: bytes) -> list[bytes]:
    """The text's units; joined they are the text."""
    made = _units(text, np.array([0]), passages.word_bounds(text))
    return [text[start:end] for start, end in zip(made.start.tolist(), made.end.tolist())]


def chunk_spans(text: bytes) -> list[tuple[int, int, int]]:
    """Start, end and number of units of the text's chunks."""
    ((starts, ends, _, held),) = spans_of([text])
    return list(zip(starts, ends, held))


def chunks(text: bytes) -> list[Chunk]:
    """The text's chunks; joined they are the text."""
    parts = [(text[start:end], held) for start, end, held in chunk_spans(text)]
    return [Chunk(content, held, len(content.split())) for content, held in parts]


def compared(chunk: Chunk) -> bytes:
    """What two occurrences must share: the bytes, without white space at the end."""
    return chunk.content.rstrip()


def removable(chunk: Chunk) -> bool:
    return chunk.units >= LEAST_UNITS and chunk.words >= LEAST_WORDS


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))


def _key(rows: DataFrame) -> DataFrame:
    """Adds ``k_id`` and ``k_text``, which name a document; ``k_id`` orders documents."""
    return rows.withColumn("k_id", _id()).withColumn("k_text", F.xxhash64("text"))


def _place(documents: DataFrame) -> Column:
    """What orders documents: ``k_id`` alone, if no two rows share it."""
    twins = documents.select(_id().alias("k_id")).groupBy("k_id").count().where("count > 1").head(1)
    return F.struct("k_id", "k_text") if twins else F.col("k_id")


_CHUNK = pa.struct([("at", pa.int32()), ("end", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("again", pa.bool_())])


def _chunk_rows(
    joined: bytes, heads: np.ndarray, words: tuple[np.ndarray, np.ndarray], keys: list[np.ndarray]
) -> tuple[list[np.ndarray], pa.Array]:
    """Of the texts that have removable chunks the keys, and an array of them each: start, end and hash
    of the chunk, and whether that hash stands earlier in the same text (``again``)."""
    made = cut(joined, heads, words)
    one = np.flatnonzero((made.held >= LEAST_UNITS) & (made.after - made.first >= LEAST_WORDS))
    bounds = zip(made.start[one].tolist(), made.trimmed[one].tolist())
    found = b"".join([xxhash.xxh3_128_digest(joined[start:end]) for start, end in bounds])
    h = (np.frombuffer(found, ">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64).reshape(-1, 2)
    text = made.text[one]
    columns = (made.start[one] - heads[text], made.end[one] - heads[text], h[:, 0], h[:, 1], passages.repeated(text, h))
    parts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHUNK)], fields=list(_CHUNK))
    firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1])[: len(text)])
    offsets = pa.array(np.append(firsts, len(text)), pa.int32())
    return [key[text[firsts]] for key in keys], pa.ListArray.from_arrays(offsets, parts)


def _pieces(documents: DataFrame, stretches: bool) -> DataFrame:
    """The chunks of the texts, a row per text, and with ``stretches`` those too, a row each; stored."""
    schema = passages.STRETCHES.append(pa.field("chunks", pa.list_(_CHUNK)))

    def filled(rows: dict[str, pa.Array]) -> pa.RecordBatch:
        size = len(rows["k_id"])
        return pa.RecordBatch.from_arrays([rows.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for group in passages.together(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                *keys, texts = zip(*group)
                keys = [np.array(key, np.int64) for key in keys]
                joined, heads = passages.joined_texts(texts)
                words = passages.word_bounds(joined)
                if stretches:
                    rows = passages.stretch_rows(joined, heads, words, keys)
                    yield filled(dict(zip(rows.schema.names, rows.columns)))
                named, chunks = _chunk_rows(joined, heads, words, keys)
                yield filled({"k_id": pa.array(named[0]), "k_text": pa.array(named[1]), "chunks": chunks})

    rows = _key(documents.select("doc_id", F.col("text"))).where("text IS NOT NULL")
    found = map_arrow(
        rows.select("k_id", "k_text", F.col("text").cast("binary")), read,
        "a bigint, h1 bigint, h2 bigint, k_id bigint, k_text bigint, cores bigint, at int, n int, back int, again boolean, "
        "chunks array<struct<at:int,end:int,h1:bigint,h2:bigint,again:boolean>>",
    )
    folder = shared_dir(documents.sparkSession, "pieces")
    # A dictionary of hashes would be made for nothing.
    hashes = ("a", "h1", "h2", "cores", "at", "chunks.list.element.h1", "chunks.list.element.h2")
    found.write.options(**{f"parquet.enable.dictionary#{name}": "false" for name in hashes}).parquet(folder)
    return documents.sparkSession.read.schema(found.schema).parquet(folder)


def _marks(pieces: DataFrame, place: Column) -> DataFrame:
    """Per document an array of its chunks whose hash occurs again: start (``at``), end, hash,
    first or not."""
    found = pieces.where("chunks IS NOT NULL").selectExpr("k_id", "k_text", "inline(chunks)")
    # Equal rows of one document are one occurrence.
    repeated = found.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.max("again").alias("twice")
    ).where("twice OR first <> last").select("h1", "h2", "first")
    repeated = staged(repeated, "chunk-repeats").hint("shuffle_hash")
    keeps = ~F.col("again") & (F.col("first") == place)
    marked = found.join(repeated, ["h1", "h2"]).groupBy("k_id", "k_text").agg(
        F.collect_set(F.struct("at", "end", "h1", "h2", keeps.alias("keeps"))).alias("marks")
    )
    return staged(marked, "chunk-marks")


def _contents(marked: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``content`` and place of every marked chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            numbers, contents = [], []
            texts = batch.column(2).to_pylist()
            rows = zip(texts, spans_of(texts), batch.column(3).to_pylist())
            for number, (data, (starts, _, trimmed, _), ats) in enumerate(rows):
                until = dict(zip(starts, trimmed))
                contents += [data[at : until[at]] for at in ats]
                numbers += [number] * len(ats)
            keys = (batch.column(k).take(pa.array(numbers, pa.int32())) for k in range(2))
            at, h1, h2 = (batch.column(k).flatten() for k in (3, 4, 5))
            yield pa.RecordBatch.from_arrays(
                [h1, h2, pa.array(contents, pa.binary()), *keys, at], ["h1", "h2", "content", "k_id", "k_text", "at"]
            )

    rows = marked.where("marks IS NOT NULL").selectExpr(
        "k_id", "k_text", "cast(text AS binary)", "marks.at", "marks.h1", "marks.h2"
    )
    return map_arrow(rows, read, "h1 bigint, h2 bigint, content binary, k_id bigint, k_text bigint, at int")


def _mixed_hashes(marked: DataFrame) -> DataFrame:
    """Hashes that stand for more than one byte string. Copies meet map-side: a hash leaves a
    task with its least and greatest string only."""
    strings = _contents(marked).groupBy("h1", "h2").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    return strings.where("a <> b").select("h1", "h2")


def _resolved(marked: DataFrame, mixed: DataFrame) -> DataFrame:
    """The marks anew, for the documents that hold a mixed hash: strings decide instead."""
    places = _contents(marked).join(mixed, ["h1", "h2"], "left_semi")
    first = F.min(F.struct("k_id", "k_text", "at")).alias("first")
    named = places.groupBy("h1", "h2", "content").agg(first)
    places = places.join(named, ["h1", "h2", "content"]).selectExpr(
        "k_id", "k_text", "at", "first = named_struct('k_id', k_id, 'k_text', k_text, 'at', at) AS keeps"
    )
    anew = places.groupBy("k_id", "k_text").agg(F.collect_set(F.struct("at", "keeps")).alias("anew"))
    joined = marked.join(anew, ["k_id", "k_text"], "left")

    def fix(mark: Column) -> Column:
        known = F.exists("anew", lambda x: x.at == mark.at)
        keeps = F.exists("anew", lambda x: (x.at == mark.at) & x.keeps)
        return mark.withField("keeps", F.when(known, keeps).otherwise(mark.keeps))

    fixed = F.transform("marks", fix)
    return joined.withColumn("marks", F.when(F.col("anew").isNull(), F.col("marks")).otherwise(fixed)).drop("anew")


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents with repeated chunks removed from ``text``; rows, other columns and their
    order stay. ``removed`` (array of struct start, end in bytes) is added last, in place of a
    column of that name."""
    return _named(documents, _without_repeats(documents, _chunk_marks))


def dedup_passages(documents: DataFrame) -> DataFrame:
    """As ``dedup_lines``, and without the passages that occur again; overlapping parts are one
    in ``removed``."""
    return _named(documents, cut_passages(documents))


def cut_passages(documents: DataFrame) -> DataFrame:
    """Per row ``row`` (a struct of its columns, as they were), ``kept_text`` and ``removed``,
    whatever the columns' names."""
    return _without_repeats(documents, _both_marks)


def _named(documents: DataFrame, cut: DataFrame) -> DataFrame:
    fields = [
        F.col("kept_text").alias("text") if name == "text" else F.col("row").getField(name).alias(name)
        for name in documents.columns if name != "removed"
    ]
    return cut.select(*fields, "removed")


def _chunk_marks(documents: DataFrame, place: Column) -> DataFrame:
    with consumed(documents.sparkSession, "chunk-marks"):
        marks = _marks(_pieces(documents, False), place)
    return marks.withColumn("runs", F.expr(f"cast(NULL AS {_RUNS})"))


def _both_marks(documents: DataFrame, place: Column) -> DataFrame:
    with consumed(documents.sparkSession, "chunk-marks", "passage-again", "passage-marked"):
        pieces = _pieces(documents, True)
        marks = _marks(pieces, place)
        runs = passages.runs(pieces.where("a IS NOT NULL").drop("chunks"), place)
    return marks.join(runs, ["k_id", "k_text"], "full")


def _without_repeats(documents: DataFrame, mark: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    place = _place(documents)
    with consumed(documents.sparkSession, "chunk-marked"):
        marked = _marked(documents, mark(documents, place))
    return _cut_out(documents, marked, place)


def _marked(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """Every row as a struct, with what is marked in it, stored by ``kind``: rows with nothing
    marked, which no later step reads, rows with marks, and rows with windows to check."""
    spark = documents.sparkSession
    names = documents.columns
    packed = documents.select(F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"), "doc_id", "text")
    keyed = _key(packed)
    # Whole rows need no sort where the marks of a partition, far smaller, are hashed.
    marked = keyed.join(marks.hint("shuffle_hash"), ["k_id", "k_text"], "left").select(
        "row", "k_id", "k_text", "marks", "runs", F.expr(
            f"CASE WHEN exists(runs, r -> r.check) THEN {_CHECKED} WHEN marks IS NULL AND runs IS NULL THEN {_UNMARKED} "
            f"ELSE {_MARKED} END").alias("kind"),
    )
    folder = shared_dir(spark, "chunk-marked")
    packing = {"compression": "zstd", "parquet.compression.codec.zstd.level": 1}
    marked.write.options(**packing).partitionBy("kind").parquet(folder)
    return spark.read.schema(marked.schema).parquet(folder)


def _cut_out(documents: DataFrame, marked: DataFrame, place: Column) -> DataFrame:
    row_type = marked.schema["row"].dataType.simpleString()
    whole = marked.where(F.col("kind") == _UNMARKED).selectExpr(
        "row", "row.text AS kept_text", "cast(array() AS array<struct<start:bigint,end:bigint>>) AS removed"
    )
    marked = marked.where(F.col("kind") != _UNMARKED).withColumn("text", F.expr("row.text"))
    mixed = staged(_mixed_hashes(marked), "chunk-mixed")
    if mixed.head(1):
        marked = _resolved(marked, mixed)
    checked = marked.where(F.col("kind") == _CHECKED)
    with consumed(documents.sparkSession, "chunk-later-windows"):
        later = staged(passages.later_windows(checked, place), "chunk-later-windows")
    marked = marked.where(F.col("kind") == _MARKED).withColumn("later", F.expr("cast(NULL AS array<int>)")).unionByName(
        checked.join(later.hint("shuffle_hash"), ["k_id", "k_text"], "left")
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, spans = [], []
            originals = batch.column("row").field("text").cast(pa.binary()).to_pylist()
            columns = (batch.column(k).to_pylist() for k in range(1, 6))
            for data, gone, gone_end, whole_at, whole_n, later in zip(originals, *columns):
                found = [*zip(gone or (), gone_end or ())]
                windows = [*zip(whole_at or (), whole_n or ()), *((at, 1) for at in later or ())]
                if windows:
                    found += passages.spans(data, windows)
                left, cut, at = [], [], 0
                for start, end in sorted(found):
                    if start < at:
                        cut[-1]["end"] = at = max(at, end)
                        continue
                    left.append(data[at:start])
                    cut.append({"start": start, "end": end})
                    at = end
                texts.append(b"".join([*left, data[at:]]).decode())
                spans.append(cut)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, kind)], ["row", "kept_text", "removed"]
            )

    schema = f"row {row_type}, kept_text string, removed array<struct<start:bigint,end:bigint>>"
    runs = "filter(runs, r -> NOT r.check)"
    gone = "filter(marks, m -> NOT m.keeps)"
    parts = marked.selectExpr(
        "row", f"{gone}.at AS gone", f"{gone}.end AS gone_end", f"{runs}.at AS whole_at", f"{runs}.n AS whole_n", "later"
    )
    return whole.unionByName(map_arrow(parts, remove, schema))
