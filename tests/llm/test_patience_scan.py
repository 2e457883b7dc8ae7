"""License scans against an alignment of every window, and notices that are easily mistaken."""

from __future__ import annotations

import random

import pytest

from quotelake.llm import patience

SCANNER = patience.Scanner(patience.TEMPLATES, patience.LEAST, patience.SPREAD, patience.NAMING)


@pytest.mark.parametrize(
    "text, names",
    [
        ("Released under the BSD License", ["bsd-name"]),
        ("Released under the Some Other License", []),
        ("Licensed under CC BY-ND 4.0", ["cc-by-nd-4.0"]),
        ("Licensed under CC BY 4.0", ["cc-by-4.0"]),
        ("Licensed under CC BY-XY 4.0", []),
        ("This work is licensed under the GNU General Public License, version 2", ["gpl-2.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3", ["lgpl-3.0"]),
        ("This program is licensed under the GNU Affero General Public License, version 3.", ["agpl-3.0"]),
        ("Released under the MIT License. It also holds parts that are Licensed under the Apache License, Version 2.0.", ["mit", "apache-2.0"]),
        (patience.TEMPLATES["apache-2.0-notice"], ["apache-2.0-notice"]),
        ("", []),
    ],
)
def test_names_and_versions(text, names):
    found = sorted(SCANNER.scan(patience.words_of(text)), key=lambda f: f[3])
    assert [f[0] for f in found] == names


@pytest.mark.parametrize("name", sorted(patience.TEMPLATES))
def test_every_template_is_found_in_itself(name):
    assert name in [f[0] for f in SCANNER.scan(patience.words_of("before it " + patience.TEMPLATES[name] + " after it"))]


def everywhere(scanner, words):
    """Each template by aligning every window from one of its words to the last within reach."""
    for name, template in scanner.templates.items():
        best = 0
        for first in range(len(words)):
            reach = words[first : first + scanner.spread * len(template)]
            while reach and reach[-1] not in template:
                reach.pop()
            pairs = patience.align(reach, template) if words[first] in template else []
            if len(pairs) >= scanner.least * len(template) and scanner.named(name, pairs):
                best = max(best, len(pairs))
        if best:
            yield name, best


def test_windows_lose_nothing():
    rng = random.Random(12)
    templates = {"one": "red green blue", "two": "a b c d e f g h i j", "three": "a c e red red green", "four": "blue"}
    scanner = patience.Scanner(templates, 0.8, 2, {"one": "green blue", "two": "c d"})
    words = "red green blue a b c d e f g h i j x y".split()
    hits = 0
    for _ in range(400):
        text = rng.choices(words, k=rng.randint(0, 30))
        if rng.random() < 0.7:
            whole = patience.words_of(rng.choice(list(templates.values())))
            if rng.random() < 0.5:
                whole.insert(rng.randrange(len(whole)), rng.choice(words))
            at = rng.randint(0, len(text))
            text[at:at] = whole
        found = {f[0]: f[2] for f in scanner._fullest(text)}
        wanted = dict(everywhere(scanner, text))
        assert found == wanted
        hits += len(found)
    assert hits > 300


def test_scan_columns(spark):
    from quotelake.llm import queries

    rows = spark.createDataFrame([(1, "Released under the MIT License.", 3), (2, None, 4), (None, "all rights reserved", 5)], "doc_id long, text string, license int")
    found = {r["doc_id"]: r for r in patience.license_scan(rows).collect()}
    assert found[1].license == "mit" and found[1].licenses[0].coverage == 1.0 and found[2].license is None and found[2].licenses == []
    assert found[None].license == "all-rights-reserved"
    query = queries.op6_license_scan(spark, "/root/testdata/sf0.001")
    assert query.columns == ["doc_id", "license", "coverage", "n_matched", "first_word", "last_word", "licenses"]
