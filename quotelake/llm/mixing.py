"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. Whole copies that a source's target holds for certain
are given to all its documents; the rest, a share of the source, is drawn: a document has a
random number u and inclusion odds (those of the share, times its own weight), and
documents are ranked by odds of u divided by inclusion odds, lowest first. The sample is the
run of lowest ranks whose words stay within the rest, so its size is fixed in words, while
documents of greater weight are drawn more often; what the next document would exceed is
filled by runs of the following ones that fit, until none fits. If one more document, smaller
than twice what is left then, comes nearer to the target, the one that comes nearest is drawn
as well. The threshold of a source is found by exact counts
over all partitions (``cuts``); no source is sorted or gathered.

The random number is a hash of seed, ``doc_id`` and text: reruns agree whatever the
partitions. Rows that agree in both stand together, all drawn or none.

Sources are few by nature: their sizes are summed and targets worked out on the driver.

Nulls and edges: a null text has no words and is never drawn; a null source is a source of
its own, last in order. An empty table gives no rows. A source without words has target 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import words_sql
from quotelake.llm.cuts import cuts
from quotelake.session import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20240601
MOST_BROADCAST = 100_000
# Ranks are held as whole numbers of this many steps.
_STEPS = 1 << 52


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of the sources in order: weights repeat, a target ends at ``most`` times its
    size, and what is over goes to the others by weight until none is above."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    target = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), share * sum(sizes)
    while free:
        total = sum(weight[k] for k in free)
        full = {k for k in free if left * weight[k] / total > most * sizes[k]}
        if not full:
            for k in free:
                target[k] = left * weight[k] / total
            break
        for k in full:
            target[k] = most * sizes[k]
        left = share * sum(sizes) - sum(target)
        free -= full
    return target


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``u``, an even random number in (0, 1)."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text")
    )
    draw = f"(shiftrightunsigned(xxhash64({SEED}, doc_id, text), 12) + 0.5D) / {_STEPS}D"
    return rows.selectExpr(
        "doc_id", "source", f"bigint(size({words_sql('text')})) AS size", f"{draw} AS u", "xxhash64(text) AS text_key"
    )


def mix(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    odds: str = "ln(size + 2D)",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_key``, ``source_size``, ``target``, ``copies``.

    ``odds`` is SQL over ``size``: a document's weight in the draw, above 0.
    """
    session = documents.sparkSession
    rows = staged(sized(documents), "mix-sizes")
    # One row per source; strings sort by code point.
    sources = sorted(
        ((row["source"], int(row["size"])) for row in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()),
        key=lambda pair: (pair[0] is None, (pair[0] or "").encode()),
    )
    sizes = [size for _, size in sources]
    wanted = targets(sizes, weights, share, most)
    plan = []
    for number, ((source, size), target) in enumerate(zip(sources, wanted)):
        whole = min(math.floor(target / size), int(most)) if size else 0
        plan.append((source, number, size, target, whole, round(target - whole * size) if size else 0))
    shares = session.createDataFrame(
        plan, "source string, number bigint, source_size bigint, target double, whole int, rest bigint"
    )
    # One row per source is broadcast; its size is known from the list above.
    joined = rows.alias("r").join(
        F.broadcast(shares.alias("s")) if len(plan) <= MOST_BROADCAST else shares.alias("s"),
        F.col("r.source").eqNullSafe(F.col("s.source")),
    ).select("r.*", "number", "source_size", "target", "whole", "rest")
    # The share's own odds are the same for a whole source, so they do not move its order.
    quotient = f"(u / (1D - u)) / greatest({odds}, 1e-9D)"
    ranked = joined.selectExpr("*", f"bigint({quotient} / (1D + {quotient}) * {_STEPS}D) AS rank")
    ranked = staged(ranked.withColumn("drawn", F.lit(False)), "mix-ranked")
    rest = {number: left for _, number, _, _, _, left in plan if left > 0}
    while True:
        ranked, left = _drawn(ranked, rest)
        if left == rest:
            break
        rest = left
    return _topped_up(ranked, rest).withColumn("copies", F.expr("whole + int(drawn)")).select(
        "doc_id", "source", "size", "text_key", "source_size", "target", "copies"
    )


def _drawn(ranked: DataFrame, rest: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Draws from each source the run of lowest ranks, among documents not drawn that fit at
    all, whose words stay within what is left; returns what is left then."""
    session = ranked.sparkSession
    if not rest:
        return ranked, rest
    left = session.createDataFrame(list(rest.items()), "number bigint, left bigint")
    # One row per source.
    left = F.broadcast(left) if len(rest) <= MOST_BROADCAST else left
    able = ranked.join(left, "number").where("NOT drawn AND size > 0 AND size <= left")
    found = cuts(able, "number", ["rank"], "size", {number: [words] for number, words in rest.items()}, {}, under=True)
    # Boundaries are unsigned; ranks are not negative, so the sign bit is set in all of them.
    limits = [
        (number, min(cut.boundary - (1 << 63), (1 << 63) - 1), rest[number]) for number, [cut] in found.items()
    ]
    limit = session.createDataFrame(limits, "number bigint, below bigint, left bigint")
    limit = F.broadcast(limit) if len(limits) <= MOST_BROADCAST else limit
    drawn = "drawn OR coalesce(size > 0 AND size <= left AND rank < below, false)"
    after = ranked.join(limit, "number", "left").withColumn("drawn", F.expr(drawn)).drop("below", "left")
    still = {number: rest[number] - cut.below for number, [cut] in found.items()}
    return staged(after, "mix-drawn"), {number: words for number, words in still.items() if words > 0}


def _topped_up(ranked: DataFrame, rest: dict[int, int]) -> DataFrame:
    """Draws from each source the document over what is left that comes nearest to it, if that
    is nearer than stopping short. Rows of one rank count together."""
    if not rest:
        return ranked
    left = ranked.sparkSession.createDataFrame(list(rest.items()), "number bigint, left bigint")
    left = F.broadcast(left) if len(rest) <= MOST_BROADCAST else left
    able = ranked.join(left, "number").where("NOT drawn AND size > 0 AND size < 2 * left")
    together = able.groupBy("number", "rank", "left").agg(F.sum("size").alias("words")).where("words < 2 * left")
    nearest = together.groupBy("number").agg(F.expr("min(struct(abs(words - left) AS off, rank))").alias("best"))
    # One row per source at most.
    nearest = staged(nearest.selectExpr("number", "best.rank AS extra"), "mix-extra")
    nearest = F.broadcast(nearest) if len(rest) <= MOST_BROADCAST else nearest
    drawn = "drawn OR coalesce(rank = extra AND size > 0, false)"
    return ranked.join(nearest, "number", "left").withColumn("drawn", F.expr(drawn)).drop("extra")


def repeated(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, in its own columns."""
    counted = mixed.where("copies > 0").selectExpr(
        "doc_id AS m_id", "source AS m_source", "text_key AS m_key", "copies"
    ).distinct()
    held = documents.select(
        F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("held"),
        F.col("doc_id").cast("bigint").alias("d_id"), F.col("source").cast("string").alias("d_source"),
        F.xxhash64("text").alias("d_key"),
    )
    same = F.expr("d_id <=> m_id AND d_source <=> m_source AND d_key = m_key")
    return held.join(counted, same).select("held", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("held.*")
