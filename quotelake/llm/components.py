"""Connected components by alternating large and small stars.

Each round points every node's larger neighbours to the smallest node it sees, then its
smaller ones; the edges become stars around each component's smallest node. A round is two
aggregations and joins on the node, written to the shared folder; edges never reach the
driver, and a node with very many neighbours is pre-aggregated before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.session import staged


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart: count and an order-free sum of hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    moved = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v")
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v")
    return moved.unionByName(least.selectExpr("u", "m AS v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the component's smallest node) of every node that has an edge to
    a smaller one; ``edges`` holds the long columns ``u`` and ``v``. Loops and repeated edges
    do no harm; null ends are left out."""
    edges = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges = staged(_small_star(staged(_large_star(edges), "large-star")), "small-star")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.selectExpr("u AS node", "v AS label")
