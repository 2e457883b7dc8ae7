"""License scans by patience alignment.

A text's words are aligned with each license template: words that occur exactly once in
both are anchors, the longest increasing subsequence of anchors is kept, and the gaps
between kept anchors (and equal neighbours beside them) are aligned the same way. Coverage
is the share of the template's words that are aligned. Words are lower-case runs of letters
and digits, over the whole text.

A template is found where its coverage reaches ``LEAST`` within a window of ``SPREAD`` times
its length and where, besides, the words that name the license and its version are all aligned
with no other word between them: "CC BY-ND 4.0" is not CC BY 4.0, version 2 not version 3. A
window begins at every word of the text that the template has and ends with the last such word
in reach; those that hold too few of the template's words to reach the coverage are not
aligned, which loses nothing.

All licenses of a text are reported, each with its fullest alignment, in order of place; of
two whose places overlap the one with more aligned words stays.

Nulls and edges: a null or empty text has no license and an empty array; ``license`` is the one
with most aligned words, ties go to the smaller name; equal rows get equal results; an empty
table gives no rows. Other columns are not read. No exchange: each text is scanned where it is
read, and what a task holds is one text's words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import map_arrow, slices

# Short license notices.
TEMPLATES = {
    "agpl-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "bsd-name": "Released under the BSD License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}
# What names a license in its notice; a template without an entry has no name in it.
NAMING = {
    "agpl-3.0": "GNU Affero General Public License version 3",
    "apache-2.0": "Apache License Version 2.0",
    "apache-2.0-notice": "Apache License Version 2.0",
    "bsd-name": "BSD License",
    "cc-by-4.0": "CC BY 4.0",
    "cc-by-nc-4.0": "CC BY-NC 4.0",
    "cc-by-nd-4.0": "CC BY-ND 4.0",
    "cc-by-sa-4.0": "CC BY-SA 4.0",
    "gpl-2.0": "GNU General Public License version 2",
    "gpl-3.0": "GNU General Public License version 3",
    "gpl-notice": "GNU General Public License as published by the Free Software Foundation either version 3",
    "lgpl-3.0": "GNU Lesser General Public License version 3",
    "mit": "MIT License",
    "mpl-2.0": "Mozilla Public License v. 2.0",
}
LEAST = 0.8
SPREAD = 2
_FOUND = "license: string, coverage: double, n_matched: int, first_word: int, last_word: int"
SCANS = f"doc_id bigint, {_FOUND.replace(':', '')}, licenses array<struct<{_FOUND}>>"
_NONE = (None, 0.0, 0, None, None)

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(values)
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[at] = top_at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            top_at.append(at)
        else:
            tops[pile], top_at[pile] = value, at
    chain, at = [], top_at[-1] if top_at else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, increasing in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a_from, a_to, b_from, b_to = todo.pop()
        # Equal words at both ends of a gap belong together.
        while a_from < a_to and b_from < b_to and a[a_from] == b[b_from]:
            pairs.append((a_from, b_from))
            a_from, b_from = a_from + 1, b_from + 1
        while a_from < a_to and b_from < b_to and a[a_to - 1] == b[b_to - 1]:
            a_to, b_to = a_to - 1, b_to - 1
            pairs.append((a_to, b_to))
        if a_from == a_to or b_from == b_to:
            continue
        in_a, in_b = Counter(a[a_from:a_to]), Counter(b[b_from:b_to])
        place = {a[k]: k for k in range(a_from, a_to) if in_a[a[k]] == 1 and in_b[a[k]] == 1}
        anchors = [(place[b[k]], k) for k in range(b_from, b_to) if b[k] in place and in_b[b[k]] == 1]
        kept = [anchors[k] for k in increasing([x for x, _ in anchors])]
        if not kept:
            continue
        pairs += kept
        edges = [(a_from - 1, b_from - 1), *kept, (a_to, b_to)]
        for (a_left, b_left), (a_right, b_right) in zip(edges, edges[1:]):
            todo.append((a_left + 1, a_right, b_left + 1, b_right))
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: dict[str, str], least: float, spread: int, naming: dict[str, str] | None = None):
        self.templates = {name: words_of(text) for name, text in sorted(templates.items())}
        self.sets = {name: set(words) for name, words in self.templates.items()}
        self.vocabulary = set().union(*self.sets.values()) if self.sets else set()
        self.least, self.spread = least, spread
        self.naming = {}
        for name, text in (naming or {}).items():
            if name in self.templates:
                phrase, template = words_of(text), self.templates[name]
                starts = [k for k in range(len(template)) if template[k : k + len(phrase)] == phrase]
                if not starts:
                    raise ValueError(f"the template {name} does not hold its name {text!r}")
                self.naming[name] = range(starts[0], starts[0] + len(phrase))

    def named(self, name: str, pairs: list[tuple[int, int]]) -> bool:
        """Whether the words that name the license are aligned, in the text side by side."""
        at = {b: a for a, b in pairs}
        places = [at.get(k) for k in self.naming.get(name, ())]
        return None not in places and all(y == x + 1 for x, y in zip(places, places[1:]))

    def scan(self, words: list[str]) -> list[tuple[str, float, int, int, int]]:
        """License, coverage, aligned words, first and last aligned word of all that are found."""
        found: list[tuple[str, float, int, int, int]] = []
        for each in sorted(self._fullest(words), key=lambda f: (-f[2], f[0])):
            if all(each[4] < other[3] or each[3] > other[4] for other in found):
                found.append(each)
        return found

    def _fullest(self, words: list[str]) -> Iterator[tuple[str, float, int, int, int]]:
        """Each template that is found, where most of it is aligned."""
        held = [(at, word) for at, word in enumerate(words) if word in self.vocabulary]
        present = {word for _, word in held}
        for name, template in self.templates.items():
            need = self.least * len(template)
            # No alignment covers more of the template than words that the text has at all.
            if sum(word in present for word in template) < need:
                continue
            own = [(at, word) for at, word in held if word in self.sets[name]]
            best = _NONE
            for first, last in self._windows(own, template, need):
                pairs = align(words[first:last], template)
                if len(pairs) >= need and len(pairs) > best[2] and self.named(name, pairs):
                    best = (name, len(pairs) / len(template), len(pairs), first + pairs[0][0], first + pairs[-1][0])
                if best[2] == len(template):
                    break
            if best[0]:
                yield best

    def _windows(self, held: list[tuple[int, str]], template: list[str], need: float) -> Iterator[tuple[int, int]]:
        """Runs of text, one from each template word in it, that hold enough of the template."""
        wanted, inside, covered, right = Counter(template), Counter(), 0, 0
        for left, (at, word) in enumerate(held):
            while right < len(held) and held[right][0] < at + self.spread * len(template):
                met = held[right][1]
                inside[met] += 1
                covered += inside[met] <= wanted[met]
                right += 1
            if covered >= need:
                yield at, held[right - 1][0] + 1
            covered -= inside[word] <= wanted[word]
            inside[word] -= 1


def license_scan(
    documents: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, spread: int = SPREAD,
    naming: dict[str, str] | None = None,
) -> DataFrame:
    """``doc_id``, ``license`` (null: none), ``coverage``, ``n_matched``, ``first_word``,
    ``last_word`` of the fullest one, and ``licenses``, all that are found."""
    known = templates if templates is not None else TEMPLATES
    names = naming if naming is not None else NAMING if templates is None else {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known, least, spread, names)
        kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        fields = ["license", "coverage", "n_matched", "first_word", "last_word"]
        listed = pa.list_(pa.struct(list(zip(fields, kinds))))
        for batch in slices(batches):
            found = [scanner.scan(words_of(text)) for text in batch.column(1).to_pylist()]
            fullest = [all_[0] if all_ else _NONE for all_ in found]
            columns = [batch.column(0), *(pa.array(column, kind) for column, kind in zip(zip(*fullest), kinds))]
            ordered = [[dict(zip(fields, each)) for each in sorted(all_, key=lambda f: f[3])] for all_ in found]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ordered, listed)], ["doc_id", *fields, "licenses"])

    return map_arrow(documents.select(F.col("doc_id").cast("bigint"), F.col("text")), scan, SCANS)
