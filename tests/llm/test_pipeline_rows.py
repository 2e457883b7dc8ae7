"""Every stage of the pipeline, and the whole run, against a plain version of its decision."""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from test_operators import WORD, ids_of, linked, mcd

import corpus_pipeline
from quotelake.llm import jaccard, line_chunks, mixing, outliers, packing, passages
from quotelake.llm.tokens import Encoder, default_path
from quotelake.session import staged

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def made():
    rng = random.Random(23)
    word = lambda: "".join(rng.choices("aeioubcdlmnrst", k=rng.randint(2, 8)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "."
    passage = " ".join(word() for _ in range(70))
    lines = "\n".join(sentence() for _ in range(5)) + "\n"
    single = [" ".join(word() for _ in range(45)) for _ in range(3)]
    texts = []
    for k in range(160):
        text = "\n".join(sentence() for _ in range(rng.randint(5, 30)))
        if k % 9 == 1:
            text = f"{sentence()} {passage} {text}"
        if k % 11 == 2:
            text = f"{lines}{text}"
        if k % 16 == 3:
            text = text.replace(".", " ### $$$ %%%")
        if k % 8 == 4:
            # One line, too short for a passage and no two units: left to the Jaccard join.
            text = single[k % 3]
            if k % 24 == 12:
                # Linked by five words and 80 %, not by three words and 90 %.
                text = " ".join([*text.split()[:-3], word(), *text.split()[-2:]])
        if k % 40 == 5:
            text = texts[k - 5]
        texts.append(text)
    texts += [None, "", "too short", "again and again " * 20, sentence() * 700]
    return [(k, t, "en", "ab"[k % 2], len(t or "")) for k, t in enumerate(texts)]


def quality(rows):
    sound = defaultdict(list)
    for row in rows:
        text = row[1] or ""
        words = WORD.findall(text)
        windows = defaultdict(list)
        for at in range(len(words) - 7):
            windows[tuple(words[at : at + 8])].append(at)
        again = len({at + k for places in windows.values() if len(places) > 1 for at in places for k in range(8)})
        if len(words) >= 20 and 100 * again <= 30 * len(words):
            lines = [line for line in text.split("\n") if WORD.search(line)]
            n = len(words) + outliers.PRIOR_WORDS
            sound[row[2:4]].append((row, [
                math.log((sum(map(len, words)) + outliers.PRIOR_WORDS * outliers.PRIOR_CHARS) / n),
                math.log1p(50 * len(re.findall(r"[#*$%&|<>]", text)) / n),
                math.log1p(50 * (len(lines) - len(set(lines))) / n),
                math.log1p(10 * again / n),
            ]))
    floor = np.array([f for _, f in outliers.FEATURES.values()]) * outliers.UNIT
    kept = []
    for held in sound.values():
        assert len(held) >= outliers.LEAST
        distances = mcd(np.round(np.array([x for _, x in held]) * outliers.UNIT), floor)
        kept += [row for (row, _), d2 in zip(held, distances) if d2 <= outliers.CUTOFF]
    return kept


def without_repeats(rows):
    """Bytes that lie in a repeated chunk, or between the first and last word of windows in a
    row that stand earlier; white space after them goes as ``passages.spans`` says."""
    seen_chunks, seen_windows, kept = set(), set(), []
    for row in sorted(rows):
        data = row[1].encode()
        gone = np.zeros(len(data), bool)
        at = 0
        for chunk in line_chunks.chunks(data):
            if line_chunks.removable(chunk):
                content = chunk.content.rstrip()
                if content in seen_chunks:
                    gone[at : at + len(chunk.content)] = True
                seen_chunks.add(content)
            at += len(chunk.content)
        words = [m.span() for m in BYTES.finditer(data)]
        covered = [False] * (len(words) + 1)
        for first in range(len(words) - passages.RUN + 1):
            window = data[words[first][0] : words[first + passages.RUN - 1][1]]
            if window in seen_windows:
                covered[first : first + passages.RUN] = [True] * passages.RUN
            seen_windows.add(window)
        begin = None
        for k, inside in enumerate(covered):
            if inside and begin is None:
                begin = words[k][0]
            if not inside and begin is not None:
                end = words[k - 1][1]
                after = words[k][0] if k < len(words) else len(data)
                line_start = begin == 0 or data[begin - 1 : begin] == b"\n"
                gone[begin : after if line_start or b"\n" not in data[end:after] else end] = True
                begin = None
        if not gone.any():
            kept.append(row)
            continue
        text = bytes(b for b, g in zip(data, gone) if not g).decode()
        if WORD.search(text):
            kept.append((row[0], text, *row[2:4], len(text)))
    return kept


def one_of_each(rows):
    groups = {key: group for key, _, group in linked(rows, jaccard.WORDS, jaccard.PERCENT)}
    return [row for row in rows if groups[row[0]] == row[0]]


def mixed(rows):
    by = defaultdict(list)
    for row in rows:
        seed = 42
        for part in (mixing.SEED.to_bytes(4, "little"), row[0].to_bytes(8, "little"), row[1].encode()):
            seed = xxhash.xxh64_intdigest(part, seed)
        u = ((seed >> 12) + 0.5) / (1 << 52)
        size = len(WORD.findall(row[1]))
        by[row[3]].append((u / (1 - u) / math.log(size + 2), size, row))
    names = sorted(by)
    sizes = [sum(size for _, size, _ in by[name]) for name in names]
    out = []
    for name, size, target in zip(names, sizes, mixing.targets(sizes)):
        whole = min(math.floor(target / size), 2)
        rest, drawn = round(target - whole * size), set()
        before = None
        while rest != before:
            before = left = rest
            for _, words, row in sorted(h for h in by[name] if h[2] not in drawn and 0 < h[1] <= rest):
                if words > left:
                    break
                left -= words
                drawn.add(row)
            rest = left
        over = [(abs(h[1] - rest), h[0], h[2]) for h in by[name] if h[2] not in drawn and 0 < h[1] < 2 * rest]
        if over:
            drawn.add(min(over)[2])
        out += [row for _, _, row in by[name] for _ in range(whole + (row in drawn))]
    return out


def packed(rows, encoder):
    """The pieces, and how many tokens each sequence holds."""
    found = []
    for row in rows:
        ids = ids_of(encoder, row[1])
        for start in range(0, len(ids), packing.LENGTH):
            piece = np.array(ids[start : start + packing.LENGTH], "<u4").tobytes()
            found.append((row[0], start, len(piece) // 4, zlib.crc32(piece), len(ids)))
    packs: list[int] = []
    for size, left in sorted(Counter(p[2] for p in found).items(), reverse=True):
        while left and packs and packs[0] + size <= packing.LENGTH:
            heapq.heapreplace(packs, packs[0] + size)
            left -= 1
        # Pieces of one length that find no room open a sequence each.
        for _ in range(left):
            heapq.heappush(packs, size)
    return Counter(found), Counter(packs)


def packed_rows(rows):
    filled, pieces = Counter(), Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    return pieces, Counter(filled.values())


def test_rows_of_every_stage_and_of_the_run(spark, made, tmp_path):
    plain = [quality, without_repeats, one_of_each, mixed]
    rows = spark.createDataFrame(made, SCHEMA).repartition(3)
    expected = made
    for (name, stage), decide in zip(corpus_pipeline.STAGES, plain, strict=False):
        rows, before = staged(stage(spark, rows, ""), "t"), expected
        expected = decide(before)
        assert Counter(map(tuple, rows.collect())) == Counter(expected), name
        if decide is one_of_each:
            groups = {key: group for key, _, group in linked(before, 3, 90)}
            assert {row[0] for row in expected} != {row[0] for row in before if groups[row[0]] == row[0]}
        # Each stage has something to do here.
        assert Counter(expected) != Counter(before) and expected, name
    pieces = packed(expected, Encoder(default_path()))
    assert packed_rows(corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()) == pieces
    spark.createDataFrame(made, SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    assert packed_rows(corpus_pipeline.run(spark, str(tmp_path)).collect()) == pieces
    assert len(corpus_pipeline.STAGES) == len(plain) + 1
