"""Token ids of texts, with each distinct word run through the tokenizer once.

The tokenizer of ``word_bpe_49k.json`` cuts at white space before it merges, and neither
its normal form nor its lower case looks across white space. The ids of a text are
therefore the ids of its white-space-parted words in order, and a word seen before needs
no second encoding. Words are cut at blank, tab, line feed and carriage return only; rarer
white space stays inside a word, where the tokenizer itself handles it.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Words of a generation in a worker's memory, about 200 bytes each. A full generation becomes
# the old one, whose words are taken over as they are met; the one before is forgotten. A worker
# outlives its stage, so what it keeps stands beside the heap of every later stage.
MAX_WORDS = 300_000
# Longer words are encoded each time.
LONG_WORD = 200

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A run of points and commas after a Latin letter is a token run of its own.
_TAIL = re.compile(rf"(?<=[{_LETTERS}])[.,]+$")
_PLAIN = re.compile(rf"[{_LETTERS}]+")

_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


class Encoder(dict):
    """Ids by word, as little-endian unsigned 32-bit integers; a new word is encoded when asked for."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.max_words = max_words
        self.old: dict[str, bytes] = {}
        # How the tokenizer writes each plain letter before it merges.
        letters = [chr(code) for code in range(0x100) if _PLAIN.fullmatch(chr(code))]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.written = str.maketrans({letter: split(letter)[0][0] for letter in letters})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null is empty."""
        look_up, found = self.__getitem__, []
        for text in texts:
            if len(self) > self.max_words:
                self.old = dict(self)
                self.clear()
                self[""] = b""
            words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found.append(b"".join(map(look_up, words)))
        return found

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            tail = _TAIL.search(word) if word[-1] in ".," else None
            ids = self[word[: tail.start()]] + self[tail.group()] if tail else self._ids(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            # One run of letters: only lower case and merging are left to do.
            found = [token.id for token in self.model.tokenize(word.lower().translate(self.written))]
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
        ids = array("I", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def encoder(path: str) -> Encoder:
    """The worker's encoder; it keeps its words from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_documents(path: str, texts: list[str | None], end_id: int = END_ID) -> list[bytes]:
    end = np.array([end_id], dtype="<u4").tobytes()
    return [ids + end for ids in encoder(path).encode(texts)]
