"""What a Python worker keeps from task to task stays small: it outlives the stage that filled it."""

from __future__ import annotations

import numpy as np
import pytest

from quotelake.llm import jaccard, tokens
from quotelake.llm.tokens import Encoder, default_path


def test_words_kept_by_both_stages_fit_beside_the_heap():
    # About 160 and 210 bytes a word; two generations of the encoder's.
    assert 160 * jaccard.MAX_WORDS + 2 * 210 * tokens.MAX_WORDS < 150e6


def test_shingles_forget_words(monkeypatch):
    monkeypatch.setattr(jaccard, "_known", {})
    texts = [" ".join(f"w{2_000 * k + n}" for n in range(2_000)) for k in range(150)]
    first = jaccard.shingles(texts[0], 5)
    for text in texts:
        jaccard.shingles(text, 5)
        assert len(jaccard._known) <= 102_000
    assert np.array_equal(jaccard.shingles(texts[0], 5), first)


@pytest.mark.parametrize("at_once", [1, 40])
def test_encoder_forgets_words_within_a_batch(at_once):
    encoder = Encoder(default_path(), max_words=300)
    texts = [" ".join(f"w{100 * k + n}" for n in range(100)) for k in range(40)] + ["w1 " + "x" * 5_000 + " w2"]
    found = []
    for first in range(0, len(texts), at_once):
        found += encoder.encode(texts[first : first + at_once])
        assert len(encoder) <= 401 and len(encoder.old) <= 401
    assert max(map(len, encoder)) <= 200
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
