"""Exact dedup by a tree-merge of sorted digest runs, with DataFrame functions only.

Two texts are equal when they are identical without the white space ``[\\x20\\x09-\\x0D]``.
Every scan partition gives a run: its digests, each once, with the smallest identifier (most
code points in the original text, then smallest ``doc_id``, then the row's number) and a
count. Runs are merged in rounds. In a round of ``bits`` bits, run ``r`` exchanges with the
``2**bits - 1`` runs whose numbers differ from its own in these bits, and keeps the digests
whose checksum has its bits: each task sorts and merges ``2**bits`` sorted runs into one. After
all rounds a digest lies in one run, and no run ever holds more than its share of the digests,
since equal ones are merged before each exchange; a group with a third of all rows is one
entry of a run.

The first tree merges digests alone and finds the repeated ones. The second merges the
normalised texts of these, compares them byte by byte at every level and ends the job with an
error if two different texts have one digest, so no result rests on a digest alone.

Repeated digests are joined back to the rows: those of large groups, of which there are at
most ``HOT_GROUPS``, are broadcast; the rest is a shuffle join whose keys are all small.

Nulls and edges: a null text is the empty text; texts of white space only equal the empty
text. A null ``doc_id`` comes after all others. Rows equal in text length and ``doc_id`` are
told apart by their place in the scan, so one row of each group stays. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import partitions
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.session import staged

# Bits by which the runs of a round differ: eight runs are merged into one.
BITS = 3
# At most so many groups are broadcast; each holds more than this share of the rows.
HOT_GROUPS = 10_000

SHA_256 = "sha2({0}, 256)"


def normalised(text: str) -> str:
    """SQL: the text without white space; null is empty."""
    return f"regexp_replace(coalesce({text}, ''), '[\\\\x20\\\\x09-\\\\x0D]', '')"


def run_count(rows: DataFrame) -> int:
    """Number of runs, a power of two not above the number of shuffle partitions."""
    return 1 << (max(2, partitions(rows)).bit_length() - 1)


def tree_merge(runs: DataFrame, count: int, merge: dict[str, str], bits: int = BITS) -> DataFrame:
    """Merges ``runs`` (``run``, ``digest`` and the columns of ``merge``) until each digest lies
    in one run. ``merge`` gives each column's aggregate, which must not depend on the order of
    its entries and may be applied to its own results."""
    aggregates = [F.expr(how).alias(name) for name, how in merge.items()]
    merged = runs.groupBy("run", "digest").agg(*aggregates)
    done = 0
    while 1 << done < count:
        taken = ((1 << bits) - 1) << done & (count - 1)
        partner = f"int((run & {count - 1 - taken}) | (crc32(digest) & {taken}))"
        moved = merged.withColumn("run", F.expr(partner)).repartitionById(count, "run")
        merged = moved.groupBy("run", "digest").agg(*aggregates)
        done += bits
    return merged.drop("run")


def _digests(documents: DataFrame, digest: str) -> DataFrame:
    """``row``, ``doc_id``, ``n_chars`` and ``digest`` of every row."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("n_chars"),
        F.unhex(F.expr(digest.format(normalised("text")))).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return staged(rows, "merge-digests")


def _verify(documents: DataFrame, ids: DataFrame, count: int, digest: str, bits: int) -> int:
    """Merges the texts of the named documents by digest, comparing bytes at every level; the
    number of their digests. Two texts of one digest are an error."""
    source = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    named = source.join(broadcast_if(fits(ids, 200_000), ids), "doc_id", "left_semi")
    named = named.unionByName(source.where("doc_id IS NULL"))
    texts = named.selectExpr(f"{normalised('text')} AS text").selectExpr(
        f"int(spark_partition_id() & {count - 1}) AS run", f"unhex({digest.format('text')}) AS digest", "text"
    )
    same = (
        "CASE WHEN min(text) = max(text) THEN min(text) "
        "ELSE raise_error('two different texts have the same digest') END"
    )
    merged = tree_merge(texts, count, {"text": same}, bits)
    # Written, so that every comparison has been made before a group is believed.
    return staged(merged.selectExpr("digest", "octet_length(text) AS n_bytes"), "merge-verified").count()


def equal_groups(
    documents: DataFrame, digest: str = SHA_256, bits: int = BITS, hot_groups: int = HOT_GROUPS
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row.
    ``digest`` is SQL for the hexadecimal digest of a text."""
    rows = _digests(documents, digest)
    count = run_count(documents)
    runs = rows.selectExpr(
        f"int(shiftright(row, 33) & {count - 1}) AS run", "digest",
        "struct(-n_chars AS n, doc_id IS NULL AS none, doc_id AS id, row) AS keep", "1L AS size",
    )
    groups = staged(tree_merge(runs, count, {"keep": "min(keep)", "size": "sum(size)"}, bits), "merge-groups")
    least = max(2, -(-rows.count() // hot_groups))
    found = groups.where("size > 1").selectExpr("digest", "keep.id AS keep_id", "keep.row AS keep_row", "size")
    hot = F.broadcast(found.where(f"size >= {least}"))
    cold = found.where(f"size < {least}")
    of_hot = rows.join(hot, "digest")
    of_cold = rows.join(hot, "digest", "left_anti").join(cold, "digest", "left")
    placed = staged(of_hot.unionByName(of_cold, allowMissingColumns=True), "merge-placed")
    ids = staged(placed.where("size > 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "merge-ids")
    _verify(documents, ids, count, digest, bits)
    return placed.selectExpr(
        "doc_id",
        "CASE WHEN size IS NULL THEN doc_id ELSE keep_id END AS keep_id",
        "coalesce(size, 1L) AS group_size",
        "coalesce(keep_row = row, true) AS kept",
        "lower(hex(digest)) AS text_sha256",
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents that stay, in their own columns. Rows of one ``doc_id`` stay together if
    one of them stays; rows without ``doc_id`` stay."""
    judged = equal_groups(documents)
    staying = judged.groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = staged(staying.where("NOT kept AND doc_id IS NOT NULL").selectExpr("doc_id AS gone_id"), "merge-gone")
    gone = broadcast_if(fits(gone, 200_000), gone)
    return documents.join(gone, documents["doc_id"].cast("bigint") == gone["gone_id"], "left_anti")
