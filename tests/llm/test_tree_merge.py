"""Exact dedup by tree-merge against plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quotelake.llm import tree_merge

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
SCHEMA = "doc_id long, text string, row long, digest string, gone_id int, keep string, size int"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    """One row of each group stays; of rows equal in length and id, any."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), place == 0, digest) for place, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(3)
    base = ["".join(rng.choices("ab \n\té漢", k=rng.randint(0, 6))) for _ in range(150)]
    out = [(n, rng.choice(base)) for n in range(500)]
    out += [(1000 + n, " hot " + " " * (n % 5)) for n in range(400)]
    out += [(2000, None), (2001, ""), (2002, " \x0b\x0c\r"), (None, "no id"), (None, "noid "), (None, "no id "), (7, "noid")]
    out += [(3000, "twice"), (3000, "twice"), (3001, "x" * 200_000), (3002, "x " * 100_000), (3003, "a\x1cb"), (3004, "ab\xa0")]
    return out


def rows_of(spark, pairs):
    return spark.createDataFrame([(d, t, 1, "d", 2, "k", 3) for d, t in pairs], SCHEMA).repartition(6)


@pytest.mark.parametrize("bits, hot_groups", [(3, 10_000), (1, 3), (2, 1)])
def test_groups(spark, pairs, bits, hot_groups):
    found = tree_merge.equal_groups(rows_of(spark, pairs), bits=bits, hot_groups=hot_groups)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == brute(pairs)


def test_different_texts_of_one_digest_are_an_error(spark, pairs):
    weak = "substring(sha2({0}, 256), 1, 2)"
    with pytest.raises(Exception, match="same digest"):
        tree_merge.equal_groups(rows_of(spark, pairs), digest=weak).collect()


def test_an_empty_table_gives_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tree_merge.equal_groups(empty).collect() == []
    assert tree_merge.without_copies(empty).collect() == []


def test_a_run_never_holds_more_than_its_share(spark):
    """A digest with most of the rows is one entry of a run before it is exchanged."""
    rows = spark.range(4000).selectExpr(
        "int(id % 4) AS run", "unhex(sha2(IF(id % 3 = 0, 'hot', string(id)), 256)) AS digest", "1L AS size"
    )
    merged = tree_merge.tree_merge(rows, 4, {"size": "sum(size)"}, bits=1)
    assert merged.count() == merged.select("digest").distinct().count() == 4000 - 1334 + 1
    held = [row["n"] for row in merged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(held) == 4 and max(held) < 1.2 * min(held)
    assert merged.agg(F.max("size"), F.sum("size")).first() == (1334, 4000)


def test_no_python_on_the_main_path(spark, pairs):
    plan = tree_merge.equal_groups(rows_of(spark, pairs))._jdf.queryExecution().toString()
    assert not re.search("Arrow|Pandas|Python", plan)


def test_without_copies_keeps_the_documents_columns(spark, pairs):
    rows = rows_of(spark, pairs)
    left = tree_merge.without_copies(rows)
    assert left.columns == rows.columns
    wanted = {d for d, _, _, kept, _ in brute(pairs) if kept and d is not None}
    assert {r["doc_id"] for r in left.collect() if r["doc_id"] is not None} == wanted
