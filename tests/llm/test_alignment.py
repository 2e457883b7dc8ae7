"""Cross-tokenizer alignment against whole texts, and the laws of its fragments."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotelake.llm import alignment as al

TEXTS = [
    None, "", " ", "  ", "a", "\n", " lead and trail ", "two  blanks   here", "tab\tand\nline\r\nends \n\n x",
    "<|endoftext|> is plain <s> text </s> <unk> <0x0A>", "naïve café — “quotes” … don't", "▁ has the blank mark",
    "漢字と仮名 and latin", "1234567 12,345.67", "no_blank_" * 40, "a\x00b", "x   y \u0085 z w", "é ﬁ   q",
    "word " * 300, "ünïcödé wörds " * 50, "many\n" * 120, " " * 90 + "x", "same text", "same text", "ends in blanks   ",
]
SMALL = 32


def brute(texts):
    """Whole texts, plain loops."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path(al.BYTE_BPE))
    one.encode_special_tokens = True
    other = SentencePieceProcessor(model_file=public_tokenizers.path(al.PIECE_BPE))
    letters = al._byte_letters()
    out = []
    for text in texts:
        groups, links = [], []
        if text:
            a = one.encode(" " + text, add_special_tokens=False).ids
            b = other.encode(text)
            bytes_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
            bytes_b = [
                bytes([int(other.id_to_piece(i)[3:5], 16)]) if other.is_byte(i)
                else other.id_to_piece(i).replace("▁", " ").encode() for i in b
            ]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_b, at = {}, 0
                for place, piece in enumerate(bytes_b):
                    at += len(piece)
                    ends_b[at] = place
                at = first_a = first_b = 0
                for place, piece in enumerate(bytes_a):
                    at += len(piece)
                    if at in ends_b:
                        groups.append((a[first_a : place + 1], b[first_b : ends_b[at] + 1]))
                        links.append((a[place], b[ends_b[at]]))
                        first_a, first_b = place + 1, ends_b[at] + 1
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), links,
                    hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    counts = Counter(link for row in out for link in row[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (number, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for number, (n_a, n_b, links, sha) in enumerate(out)
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("size, fan, head", [(al.CHUNK, al.FAN, al.HEAD), (SMALL, 2, 40), (SMALL, 3, 0)])
def test_against_whole_texts(spark, size, fan, head):
    rows = spark.createDataFrame(
        [(n, text, "x", 1, "y") for n, text in enumerate(TEXTS)],
        "doc_id long, text string, row string, k int, links string",
    ).repartition(3)
    found = al.aligned(rows, size=size, fan=fan, head=head)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute(TEXTS)


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert al.aligned(empty, size=SMALL).collect() == []
    long = "these words are many and are cut into chunks of a few words each " * 3
    rows = spark.createDataFrame([(None, long), (7, long), (7, long), (7, None)], "doc_id long, text string")
    found = [tuple(r) for r in al.aligned(rows, size=SMALL).collect()]
    whole = brute([long, long, long])[0]
    assert sorted(r[1:] for r in found) == sorted([whole[1:]] * 3 + [(0, 0, 0, 0, 0, 0, "")])
    assert sorted(r[0] or -1 for r in found) == [-1, 7, 7, 7]


def test_tokenizers_give_the_same_ids_when_cut_and_by_the_faster_encoder():
    paths = al.default_paths()
    one, other = al.ByteTokens(paths[0]), al.PieceTokens(paths[1])
    assert one.quick is not None
    for text in filter(None, TEXTS):
        slow = one.slow.encode(" " + text, add_special_tokens=False).ids
        assert one.encode(" " + text) == slow
        for size in (5, 8, 32):
            parts = al.chunks(text, size)
            assert "".join(p.a for p in parts) == "".join(p.b for p in parts) == " " + text
            assert sum((one.encode(p.a) for p in parts if p.a), []) == slow
            assert sum(other.encode([p.b for p in parts if p.b]), []) == other.model.encode(text)


@st.composite
def _cut_tokens(draw):
    """Token ends of both sides of one text, and where each side is cut into three ranges."""
    end = draw(st.integers(1, 60))
    sides = [sorted({*draw(st.sets(st.integers(1, end))), end}) for _ in range(2)]
    cuts = [sorted(draw(st.lists(st.integers(0, len(side)), min_size=2, max_size=2))) for side in sides]
    return sides, cuts


@settings(max_examples=300, deadline=None)
@given(_cut_tokens())
def test_fragments_compose_associatively(case):
    (a, b), (cut_a, cut_b) = case
    whole = al.Tokens(np.arange(len(a)), np.array(a), np.arange(len(b)), np.array(b))
    edges_a, edges_b = [0, *cut_a, len(a)], [0, *cut_b, len(b)]
    parts = [whole.part(slice(edges_a[k], edges_a[k + 1]), slice(edges_b[k], edges_b[k + 1])) for k in range(3)]
    x, y, z = map(al.fragment, parts)
    expected = al.finished(al.fragment(whole))
    for made in (al.joined(al.joined(x, y), z), al.joined(x, al.joined(y, z))):
        found = al.finished(made)
        assert (found.text, found.links.tolist()) == (expected.text, expected.links.tolist())
        assert (made.n_a, made.n_b, len(made.suffix.a), len(made.suffix.b)) == (len(a), len(b), 0, 0)
    assert expected.text.decode().count(";") + 1 == len(expected.links) == len(whole.ends())
