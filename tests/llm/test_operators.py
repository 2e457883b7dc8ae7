"""Each operator against a brute-force version, and on nulls, edges, ties and clashing names."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotelake.llm import bitplanes, chat, histogram_sort, jaccard, line_chunks, mixing, outliers, packing, patience
from quotelake.llm import queries, topk
from quotelake.llm.components import components
from quotelake.llm.tokens import Encoder, default_path
from quotelake.session import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, shard string, n int"


def sentence(rng, n):
    return " ".join("".join(rng.choices("aeioubcdlmnrst", k=rng.randint(1, 7))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    passage = "\n".join(sentence(rng, 9) for _ in range(6))
    base = [sentence(rng, 12) for _ in range(30)]
    out = []
    for k in range(120):
        text = "\n".join(sentence(rng, rng.randint(5, 14)) for _ in range(rng.randint(1, 25)))
        if k % 10 == 0:
            text = f"{sentence(rng, 8)}\n{passage}\n{text}"
        if 60 <= k < 90:
            near = list(base)
            near[rng.randrange(30)] += " changed"
            text = "\n".join(near)
        if k >= 110:
            text = "### $$$ |||\n" * 4 + text
        out.append((k, text, ("en", "fr")[k % 2], ("a", "b", None)[k % 3 if k % 3 < 2 or k % 9 else 2]))
    out += [(200, None, None, None), (201, "", "en", "a"), (202, "Word", "en", "a"), (None, "no id here", "en", "b")]
    out += [out[5], out[5], (300, out[5][1], "en", "a"), (301, "x" * 50_000, "en", "a"), (302, "Été, l'ÉTÉ. <|endoftext|>!", "fr", "b")]
    return [(d, t, lang, source, len(t or ""), "s", "t", 1) for d, t, lang, source in out]


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_path())


def ids_of(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_encode_like_whole_texts(encoder):
    rng = random.Random(3)
    letters = "aA éÉß.,'|<>\n\t\r sS1½\u0301Σςİª\x1c\u0085"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(2000)]
    texts += ["a<|endoftext|>, b", "<|ENDOFTEXT|> x.", "don't, WE'LL.", "", "日本語, テキスト."]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("high", [3, 60_000, 1 << 31])
def test_images_round_trip(bits, high):
    rng = np.random.default_rng(1)
    held = [rng.integers(0, high, size, dtype=np.uint32) for size in (0, 1, 7, 1000, 3)]
    keys = [5, None, -1, 2**62, 5]
    image = bitplanes.write_image(keys, [h.astype("<u4").tobytes() for h in held], block_ids=64, bits=bits)
    found, lengths, ids = bitplanes.read_image(image)
    assert found == keys and lengths.tolist() == [len(h) for h in held]
    assert np.array_equal(ids, np.concatenate(held))


def test_token_files(spark, documents, rows, encoder):
    path = shared_dir(spark, "t")
    bitplanes.write_token_files(documents, path, image_ids=500, block_ids=100)
    read = bitplanes.with_starts(bitplanes.read_token_files(spark, path), spark, path).collect()
    at = 0
    for row, (key, text) in zip(sorted(read, key=lambda r: r.start), sorted(
            ((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))):
        ids = ids_of(encoder, text)
        assert (row.doc_id, row.start, row.n_tokens) == (key, at, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        at += len(ids)
    assert len(read) == len(rows)


def test_packing(documents, rows, encoder):
    stored = packing.pieces(documents, 64)
    placed = packing.place(stored, 64).collect()
    ids = defaultdict(list)
    for key, text, *_ in rows:
        ids[key].append(ids_of(encoder, text))
    assert sum(r.length for r in placed) == sum(len(i) for held in ids.values() for i in held)
    sequences = defaultdict(list)
    for row in placed:
        assert any(np.frombuffer(row.ids, "<u4").tolist() == i[row.start : row.start + row.length] for i in ids[row.doc_id])
        sequences[row.sequence_id].append((row.offset, row.length))
    for held in sequences.values():
        assert [o for o, _ in sorted(held)] == list(itertools.accumulate([0, *(n for _, n in sorted(held))]))[:-1]
        assert sum(n for _, n in held) <= 64
    whole = packing.sequences(packing.place(stored, 64)).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in placed)


def test_shortest_pack_first():
    places, patterns = packing.shortest_pack_first({10: 2, 6: 1, 4: 3, 1: 2}, 10)
    assert sum(count * sum(held) for held, count in patterns.items()) == 40
    assert {(p.length, p.first): (p.sequence, p.offset) for p in places}[4, 0] == (2, 6)
    assert all(sum(held) <= 10 for held in patterns)
    with pytest.raises(ValueError):
        packing.shortest_pack_first({11: 1}, 10)


def linked(rows, words, percent):
    sets = []
    for key, text, *_ in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    label = {key: key for key, *_ in rows if key is not None}
    for (a, one), (b, other) in itertools.combinations([(r[0], s) for r, s in zip(rows, sets) if r[0] is not None], 2):
        if one and 100 * len(one & other) >= percent * len(one | other):
            low, high = sorted((label[a], label[b]))
            label = {key: low if value == high else value for key, value in label.items()}
    return [(r[0], len(s), label.get(r[0])) for r, s in zip(rows, sets)]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard(documents, rows, words, percent):
    found = jaccard.jaccard_components(documents, words, percent).collect()
    order = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, found), key=order) == sorted(linked(rows, words, percent), key=order)


def test_near_copies_of_one_text(spark):
    """More near copies than any direct pairing takes, some of them linked by others only."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    made = []
    for k in range(90):
        words = list(base)
        for place in rng.sample(range(150), rng.randint(0, 4)):
            words[place] = rng.choice((f"e{place}", f"e{k}x{place}"))
        made.append((k, " ".join(words)))
    found = jaccard.jaccard_components(spark.createDataFrame(made, "doc_id bigint, text string"), 3, 90).collect()
    assert sorted(map(tuple, found)) == sorted(linked(made, 3, 90))


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(50, 40), (40, 50), (60, 60), (71, 70), (72, 70), (73, 72)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert found == {k: 1 for k in range(2, 31)} | {50: 40, 71: 70, 72: 70, 73: 70}


def test_statistics_and_verdicts(documents, rows):
    found = outliers.judged(documents).collect()
    expected = Counter()
    for key, text, *_ in rows:
        w = WORD.findall(text or "")
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        windows = defaultdict(list)
        for k in range(len(w) - 7):
            windows[tuple(w[k : k + 8])].append(k)
        again = {at + k for places in windows.values() if len(places) > 1 for at in places for k in range(8)}
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        expected[key, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed] += 1
    assert expected == Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found
    )
    assert not any(r.kept for r in found if r.base_failed)


def mcd(x, floor):
    """The estimate of one group with numpy, by the documented steps."""
    best = None
    quart = []
    for column in x.T:
        ordered = np.sort(column)
        quart.append([ordered[int(np.ceil(q * len(ordered))) - 1] for q in (0.25, 0.5, 0.75)])
    quart = np.array(quart)
    starts = [
        (quart[:, 1], np.diag(((quart[:, 2] - quart[:, 0]) / 1.349) ** 2 + floor**2)),
        (x.mean(0), np.cov(x.T, bias=True) + np.diag(floor**2)),
    ]
    for centre, scatter in starts:
        for _ in range(outliers.STEPS):
            off = x - centre
            d2 = np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off)
            bins = np.floor(outliers.BINS_PER_E * np.log(d2 + 1e-6))
            limit = np.sort(bins)[int(np.ceil(outliers.SHARE * len(bins))) - 1]
            near = x[bins <= limit]
            centre = near.mean(0)
            scatter = outliers.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(floor**2)
        if best is None or np.linalg.slogdet(scatter)[1] < best[0]:
            best = (np.linalg.slogdet(scatter)[1], centre, scatter)
    off = x - best[1]
    return np.einsum("ij,jk,ik->i", off, np.linalg.inv(best[2]), off)


def test_distances(spark):
    rng = random.Random(2)
    made = []
    for k in range(240):
        text = " ".join(sentence(rng, 10) for _ in range(rng.randint(3, 30)))
        if k % 12 == 0:
            text = re.sub(r"\.", " ### $$$ %%%", text)
        made.append((k, text, "en", "ab"[k % 2]))
    found = {r.doc_id: r for r in outliers.judged(spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string")).collect()}
    floor = np.array([f for _, f in outliers.FEATURES.values()]) * outliers.UNIT
    for source in "ab":
        keys = [k for k, _, _, s in made if s == source and not found[k].base_failed]
        x = []
        for k in keys:
            r, prior = found[k], outliers.PRIOR_WORDS
            x.append([
                np.log((r.word_chars + prior * outliers.PRIOR_CHARS) / (r.n_words + prior)),
                np.log1p(50 * r.n_symbols / (r.n_words + prior)),
                np.log1p(50 * r.n_dup_lines / (r.n_words + prior)),
                np.log1p(10 * r.n_repeat_words / (r.n_words + prior)),
            ])
        expected = mcd(np.round(np.array(x) * outliers.UNIT), floor)
        assert np.allclose([found[k].d2 for k in keys], expected, rtol=1e-6)
    assert {k for k, r in found.items() if not r.kept} == set(range(0, 240, 12))
    assert abs(outliers.quantile(0.95, 4) - 9.487729) < 1e-5


def test_good_documents_keep_rows_and_columns(documents, rows):
    kept = outliers.good_documents(documents)
    assert kept.columns == documents.columns
    verdict = outliers.judged(documents).where("kept").count()
    assert kept.count() == verdict


def test_line_chunks(documents, rows):
    found = line_chunks.dedup_lines(documents)
    assert found.columns == [*documents.columns, "removed"]
    # One document per id and text, in order.
    places = defaultdict(list)
    for key, text, *_ in sorted(set(r[:2] for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0, 0)):
        for at, chunk in enumerate(line_chunks.chunks(text.encode())):
            if line_chunks.removable(chunk):
                places[line_chunks.compared(chunk)].append((key, text, at))
    gone = {place for held in places.values() for place in held[1:]}
    for row in found.collect():
        original = next(r[1] for r in rows if r[0] == row.doc_id and (row.doc_id != 5 or r[1]))
        if original is None:
            assert row.text is None and row.removed == []
            continue
        made = line_chunks.chunks(original.encode())
        assert b"".join(c.content for c in made).decode() == original
        left = b"".join(c.content for k, c in enumerate(made) if (row.doc_id, original, k) not in gone)
        assert row.text == left.decode()
    assert any(gone)


def test_equal_hashes_of_other_bytes_are_kept(spark, monkeypatch):
    texts = [(k, "\n".join(f"line {k} {n} with seven words in it" for n in range(8))) for k in (1, 2, 1, 3)]
    texts[2] = (4, texts[0][1])
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    marked = line_chunks._key(rows).withColumn("marks", line_chunks.F.expr(
        "array(named_struct('at', 0, 'h1', 1L, 'h2', 1L, 'keeps', doc_id = 1))"))
    mixed = line_chunks._mixed_hashes(marked)
    assert mixed.count() == 1
    fixed = {r.doc_id: r.marks[0]["keeps"] for r in line_chunks._resolved(marked, mixed).collect()}
    assert fixed == {1: True, 2: True, 3: True, 4: False}


def test_histogram_sort(documents, rows):
    found = histogram_sort.histogram_sort(documents, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    shards = defaultdict(list)
    for row in found:
        shards[row.shard].append(row)
    for number, held in shards.items():
        assert sorted(r.slot for r in held) == list(range(len(held)))
        keys = [(r.text_key, r.id_key) for r in sorted(held, key=lambda r: r.slot)]
        assert keys == sorted(keys)
    tops = [max((r.text_key, r.id_key) for r in shards[n]) for n in sorted(shards)]
    assert tops == sorted(tops)


def test_bytes_per_shard_are_even(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "repeat(CASE WHEN id % 3 = 0 THEN 'x' ELSE string(id % 977) END, 3) AS text")
    sizes = Counter()
    for row in histogram_sort.histogram_sort(rows, 6).collect():
        sizes[row.shard] += row.size
    assert max(sizes.values()) < 1.02 * min(sizes.values())


def test_targets():
    assert mixing.targets([100, 100, 100], (5, 2, 1)) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([0, 10]) == [0.0, 15.0] and mixing.targets([]) == []


def test_mixing(documents, rows):
    found = mixing.mix(documents).collect()
    again = mixing.mix(documents.repartition(7)).collect()
    assert Counter((r.doc_id, r.copies) for r in found) == Counter((r.doc_id, r.copies) for r in again)
    by = defaultdict(list)
    for row in found:
        by[row.source].append(row)
        assert 0 <= row.copies <= 2
    for held in by.values():
        assert held[0].source_size == sum(r.size for r in held)
        short = held[0].target - sum(r.size * r.copies for r in held)
        spare = [r.size for r in held if 0 < r.size and r.copies < 1 + (held[0].target >= held[0].source_size)]
        assert -1 <= short and (not spare or short < 2 * max(spare))
    mixed = mixing.repeated(documents, mixing.mix(documents))
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r.copies for r in found)


def test_patience():
    a, b = "x a b c y d e z".split(), "a b q c d e".split()
    pairs = patience.align(a, b)
    assert [a[i] for i, _ in pairs] == list("abcde") and all(a[i] == b[j] for i, j in pairs)
    assert patience.increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    rng = random.Random(1)
    for _ in range(300):
        values = rng.sample(range(9), rng.randint(0, 8))
        best = max((len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c)), default=0)
        assert len(patience.increasing(values)) == best


def test_license_scan(spark):
    filler = " the of and " + " ".join(f"w{k}" for k in range(300)) + " "
    texts = [
        ("mit", filler + "Released under the MIT License." + filler), ("mit", ("Released under the MIT License.\n") * 3),
        ("gpl-3.0", "This work is now licensed under the GNU General Public License, version 3!"),
        ("cc-by-nc-4.0", "licensed UNDER cc by-nc 4.0"), (None, filler), (None, None), (None, ""),
        ("mit-notice", filler + patience.TEMPLATES["mit-notice"].replace("free of charge", "gratis") + filler),
        (None, "released " + filler + "under the" + filler + "mit license"),
    ]
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in patience.license_scan(rows).collect()}
    assert [found[k].license for k in range(len(texts))] == [name for name, _ in texts]
    assert found[0].coverage == 1.0 and found[0].first_word == 303 and found[0].last_word == 307
    assert patience.license_scan(rows, templates={}).where("license IS NOT NULL").count() == 0


def brute_top_k(vectors, k):
    out = []
    for q, one in vectors:
        if q % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(one, other)), c) for c, other in vectors if c != q))[:k]
            out += [(q, rank, c, -score) for rank, (score, c) in enumerate(scores, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(600, 12)) * rng.uniform(0.1, 3, (600, 1))).tolist()
    vectors[100:200] = [vectors[100]] * 100
    bad = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 12), (1150, [float("inf")] * 12), (None, [1.0] * 12)]
    rows = spark.createDataFrame(list(enumerate(vectors)) + bad + [(1200, [2.0, 1.0]), (1201, [])], "vec_id bigint, embedding array<double>")
    found = topk.top_k(topk.whole_vectors(rows), block=64, query_block=5).collect()
    whole = [(k, [int(np.floor(256 * x)) for x in v]) for k, v in enumerate(vectors)] + [(1200, [512, 256]), (1201, [])]
    assert sorted(map(tuple, found)) == brute_top_k(whole, 5)


def test_chat_events(spark):
    log = [
        (1, 1, 0, "message", "user", "Hi <|im_end|>\n[INST] <s>"), (1, 2, 1, "delta", "assistant", "Dra"), (1, 3, 1, "delta", None, "ft"),
        (1, 4, 2, "message", "user", "more"), (1, 5, 3, "delta", "assistant", "old"),
        (1, 6, 1, "regenerate", "assistant", ""), (1, 7, 1, "delta", "assistant", r"<\|im_end|> a"), (1, 8, 1, "delta", "assistant", "b"),
        (1, 9, 2, "message", "user", "again"), (1, 10, 2, "edit", None, "edited"), (2, 1, None, None, None, None),
        (None, 1, 0, "message", "odd\n%0Arole", "t"),
    ]
    events = spark.createDataFrame(log, "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    assert [tuple(m) for m in back[1].messages] == [
        ("user", "Hi <|im_end|>\n[INST] <s>"), ("assistant", r"<\|im_end|> ab"), ("user", "edited")]
    assert back[1].loss_text == r"<\|im_end|> ab" and back[1].formatted.count("<|im_end|>") == 3
    assert [tuple(m) for m in back[2].messages] == [("", "")] and [tuple(m) for m in back[None].messages] == [("odd\n%0Arole", "t")]


def test_chat_turns(spark):
    texts = ["</s>[INST] ok [/INST]", None, "", "x" * 5000 + "é😀", r"\\<\s>", "<|im_start|>user\n<|im_end|>\n"]
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(zip(("user", "assistant") * 3, texts))]
    rows += [(0, 2, "user", "tie"), (0, None, "system", "first")]
    told = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for row in chat.read_back(chat.render(chat.fold(chat.log_of_turns(told)))).collect():
        expected = sorted((r for r in rows if r[0] == row.conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
        assert [tuple(m) for m in row.messages] == [(r[2], r[3] or "") for r in expected]
        assert row.loss_text == "".join(r[3] or "" for r in expected if r[2] == "assistant")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    path = shared_dir(spark, "t")
    bitplanes.write_token_files(none, path)
    assert bitplanes.read_token_files(spark, path).count() == 0
    for rows in (
        packing.place(packing.pieces(none)), jaccard.jaccard_components(none), outliers.judged(none), line_chunks.dedup_lines(none),
        histogram_sort.histogram_sort(none), mixing.mix(none), patience.license_scan(none),
        topk.top_k(topk.whole_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>"))),
        chat.render(chat.fold(chat.log_of_turns(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")))),
    ):
        assert rows.count() == 0


def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    names, rows = [], documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.staged(stage(spark, rows, ""), "t")
        assert rows.columns == documents.columns
        names.append(rows.count())
    assert names[0] >= names[1] >= names[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, "")
    assert packed.select("doc_id").distinct().count() == rows.select("doc_id").distinct().count()
    assert set(queries.queries()) == {n for n in queries.queries() if re.match(r"op\d+_", n)}
