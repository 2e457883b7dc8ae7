"""Boundaries in a sort key below which given weights lie, found by counting only.

A key is one or two long columns, compared as signed numbers, that is 64 or 128 bits. The
bits are read from the top in steps: within every bracket that still holds a wanted
boundary, the weights of all its sub-brackets are summed exactly over all partitions, and
the sub-bracket that the boundary lies in becomes the next bracket. The driver sees at most
``ACTIVE * 2**STEP`` sums a job and no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 10
# Brackets looked into by one job; more are looked into by further jobs.
ACTIVE = 512
_FLIP = -(1 << 63)


class Cut(NamedTuple):
    """``below`` is the weight of all keys below ``boundary`` (an unsigned number)."""

    boundary: int
    below: int


class _Bracket(NamedTuple):
    group: int
    target: int
    prefix: int
    bits: int
    below: int
    weight: int


def _part(keys: list[str], first: int, bits: int) -> F.Column:
    """Bits ``first`` to ``first + bits`` of the key, within one of its columns."""
    column, at = keys[first // 64], first % 64
    flipped = F.col(column).bitwiseXOR(F.lit(_FLIP))
    return F.shiftrightunsigned(flipped, 64 - at - bits).bitwiseAND(F.lit((1 << bits) - 1))


def cuts(
    rows: DataFrame, group: str, keys: list[str], weight: str, targets: dict[int, list[int]], slack: dict[int, float],
    under: bool = False, whole: float = 0,
) -> dict[int, list[Cut]]:
    """For each group and wanted weight, the boundary nearest to it, or nearest ``under`` it.

    A boundary is taken as soon as it is within ``slack`` of the wanted weight, else bits are
    read until a single row is left, or to the last one, where equal keys remain together.
    Rows equal in the first of two key columns are not parted if they weigh ``whole`` or less.
    ``rows`` is read once a step, so it should be stored; keys and group must not be null.
    """
    width = 64 * len(keys)
    found: dict[tuple[int, int], Cut] = {}
    totals = {
        row["g"]: int(row["w"])
        for row in rows.groupBy(F.col(group).alias("g")).agg(F.sum(weight).alias("w")).collect()
    }
    active = [_Bracket(g, t, 0, 0, 0, totals.get(g, 0)) for g, wanted in targets.items() for t in sorted(set(wanted))]
    while active:
        following = []
        for first in range(0, len(active), ACTIVE):
            following += _narrow(rows, group, keys, weight, active[first : first + ACTIVE], slack, width, found, under, whole)
        active = following
    return {g: [found[g, t] for t in wanted] for g, wanted in targets.items()}


def _narrow(rows, group, keys, weight, active, slack, width, found, under, whole) -> list[_Bracket]:
    bits = active[0].bits
    step = min(STEP, 64 - bits % 64)
    session = rows.sparkSession
    wanted = {(b.group, b.prefix) for b in active}
    # The prefix as up to two signed longs, one per key column.
    low = max(0, bits - 64)

    def halves(prefix: int) -> tuple[int, int]:
        high, rest = (prefix >> low, prefix & ((1 << low) - 1)) if bits > 64 else (prefix, 0)
        return (high - (1 << 64) if high >= 1 << 63 else high), rest

    chosen = session.createDataFrame(
        [(g, *halves(prefix)) for g, prefix in wanted], "g bigint, p1 bigint, p2 bigint"
    )
    p1 = _part(keys, 0, min(bits, 64)) if 0 < bits < 64 else (
        F.col(keys[0]).bitwiseXOR(F.lit(_FLIP)) if bits >= 64 else F.lit(0).cast("bigint")
    )
    p2 = _part(keys, 64, low) if low else F.lit(0).cast("bigint")
    parts = rows.select(
        F.col(group).cast("bigint").alias("g"), p1.alias("p1"), p2.alias("p2"),
        _part(keys, bits, step).alias("digit"), F.col(weight).alias("w"),
    )
    # At most ACTIVE rows are broadcast.
    sums = parts.join(F.broadcast(chosen), ["g", "p1", "p2"]).groupBy("g", "p1", "p2", "digit").agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")
    )
    held: dict[tuple[int, int, int], dict[int, int]] = {}
    single = set()
    for row in sums.collect():
        bracket = (row["g"], row["p1"], row["p2"])
        held.setdefault(bracket, {})[row["digit"]] = int(row["w"])
        if row["n"] == 1:
            single.add((*bracket, row["digit"]))
    following = []
    for bracket in active:
        below = bracket.below
        counted = held.get((bracket.group, *halves(bracket.prefix)), {})
        for digit in sorted(counted):
            if below + counted[digit] > bracket.target:
                break
            below += counted[digit]
        else:
            digit = None
        done = bits + step
        if digit is None:
            # All of the bracket lies at or below the target.
            end = (bracket.prefix + 1) << (width - bits)
            found[bracket.group, bracket.target] = Cut(end, below)
            continue
        prefix = (bracket.prefix << step) | digit
        start, end = Cut(prefix << (width - done), below), Cut((prefix + 1) << (width - done), below + counted[digit])
        nearest = start if under else min(start, end, key=lambda cut: abs(cut.below - bracket.target))
        alone = (bracket.group, *halves(bracket.prefix), digit) in single
        kept = done == 64 and counted[digit] <= whole
        if abs(nearest.below - bracket.target) <= slack.get(bracket.group, 0) or alone or kept or done == width:
            found[bracket.group, bracket.target] = nearest
        else:
            following.append(_Bracket(bracket.group, bracket.target, prefix, done, below, counted[digit]))
    return following


def signed(boundary: int, columns: int) -> tuple[int, ...] | None:
    """A boundary as the signed values of the key columns; None lies above every key."""
    if boundary >> (64 * columns):
        return None
    mask = (1 << 64) - 1
    return tuple(((boundary >> (64 * (columns - 1 - k))) & mask) + _FLIP for k in range(columns))
