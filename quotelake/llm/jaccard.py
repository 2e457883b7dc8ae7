"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes of its distinct word shingles. Documents link when
``100 * |intersection| >= percent * |union|``. Copies of a set are one class, so each set is
joined once, by the class's smallest ``doc_id``.

All sets share one order of shingles: frequent ones last, else by hash. A document's prefix
is the first ``p + e`` shingles, where ``p`` is what any partner must meet at least once and
``e`` grows with the estimated number of candidates (the counts of its prefix shingles):
two documents are verified only if their prefixes share ``1 + min(e, e')`` shingles, which
linked ones always do. Counts are exact over the zone in which prefixes normally lie (``p``
and a quarter more, in order of hashes); a document whose zone has too few rare shingles is
lengthened to its whole set.

Pairs are verified on whole sets, made anew from the texts, in two rounds. First every class
is paired with one neighbour (the smallest holder of its shingles, where they agree most);
links so found give components. Then candidates in different components are verified, all of
them: shingles with at most ``FEW`` holders give their pairs with shared counts; of shingles
with more holders, those outside the holders' main component meet the others, by what they
differ in from their common neighbour of the first round if they have one. Pairs within a
component need no check, so a large group of near copies costs a row per copy.

Nulls and edges: texts without words have no shingles, link with nothing and are their own
component; texts with fewer words than a shingle have their whole sequence as one. Rows of
one ``doc_id`` are one document: what links to any of them links to all. Rows without
``doc_id`` link with nothing and have no component. An empty table gives no rows. Other
columns are not read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import map_arrow, slices
from quotelake.llm.components import components
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.session import consumed, shared_dir, staged

WORDS = 5
PERCENT = 80
# Shingles with more holders come last in the order.
FREQUENT = 4
# Counts from here on are part of a document's estimate.
COUNTED = 3
# Holders of a shingle that are paired with each other directly.
FEW = 32
# Of a document's shingles with more holders, those by which repeated pairs are told.
HEAD = 16
MOST_EXTRA = 4
# Words in a worker's memory, which later stages share; to hash a word anew costs little.
MAX_WORDS = 100_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_known: dict[bytes, int] = {}


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted, as unsigned 64-bit numbers."""
    global _known
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if len(_known) > MAX_WORDS:
        _known = {}
    known = _known
    for word in found:
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(words, len(hashes))
    total = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = (total ^ hashes[k : len(hashes) - size + 1 + k]) * _A
            total ^= total >> np.uint64(32)
        total *= _B
        total ^= total >> np.uint64(29)
    return np.unique(total)


def prefix_length(size: int, percent: int) -> int:
    """How many first shingles contain one of every linked partner's."""
    return size - -(-percent * size // 100) + 1


def zone_length(size: int, percent: int) -> int:
    wanted = prefix_length(size, percent)
    return min(size, wanted + wanted // 4 + 8)


def _signed(values: np.ndarray) -> np.ndarray:
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sets(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``n``, ``s1``, ``s2`` (hash of the set) and ``zone`` of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, s1, s2, zones = [], [], [], []
            for text in batch.column(1).to_pylist():
                held = shingles(text, words)
                digest = xxhash.xxh3_128_intdigest(held.tobytes())
                sizes.append(len(held))
                s1.append((digest >> 64) - (1 << 63))
                s2.append((digest & ((1 << 64) - 1)) - (1 << 63))
                zones.append(_signed(held[: zone_length(len(held), percent)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, s1, s2)), _lists(zones)],
                ["doc_id", "n", "s1", "s2", "zone"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text"))
    return map_arrow(rows, make, "doc_id bigint, n bigint, s1 bigint, s2 bigint, zone array<bigint>")


def _texts_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the named documents."""
    nodes = staged(nodes, "jaccard-nodes")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text"))
    return rows.join(broadcast_if(fits(nodes), nodes), "node", "left_semi")


def _whole_sets(documents: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = [_signed(shingles(text, words)) for text in batch.column(1).to_pylist()]
            sizes = pa.array([len(h) for h in held], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, _lists(held)], ["node", "n", "zone"])

    return map_arrow(_texts_of(documents, nodes), make, "node bigint, n bigint, zone array<bigint>")


def _extra(cost: int, size: int, percent: int) -> int:
    """More shared shingles are asked for the more candidates are to be expected."""
    wanted = 0 if cost <= 0 else min(MOST_EXTRA, 1 + (cost.bit_length() - 1) // 3)
    return max(0, min(wanted, -(-percent * size // 100) - 1))


def _prefixes(sets: DataFrame, frequent: DataFrame, percent: int, whole: bool) -> DataFrame:
    """``node``, ``n``, ``e``, ``prefix``; null ``prefix`` where the zone is too short."""
    counted = sets.select("node", F.explode("zone").alias("t")).join(
        broadcast_if(fits(frequent), frequent), "t"
    )
    counted = counted.groupBy("node").agg(F.collect_set(F.struct("t", "df")).alias("counted"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            extras, prefixes = [], []
            for n, zone, counts in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                zone = np.array(zone, dtype=np.int64)
                df = np.zeros(len(zone), dtype=np.int64)
                if counts:
                    at = {entry["t"]: entry["df"] for entry in counts}
                    df[:] = [at.get(t, 0) for t in zone.tolist()]
                ordered = np.argsort(df > FREQUENT, kind="stable")
                least = prefix_length(n, percent)
                extra = _extra(int(df[ordered[:least]].sum()), n, percent)
                extras.append(extra)
                rare = len(zone) - int((df > FREQUENT).sum())
                complete = whole or len(zone) == n or rare >= least + extra
                prefixes.append(zone[ordered[: least + extra]] if complete else None)
            offsets = np.concatenate([[0], np.cumsum([0 if p is None else len(p) for p in prefixes])]).astype(np.int32)
            held = [p for p in prefixes if p is not None]
            flat = np.concatenate(held) if held else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(flat), mask=pa.array([p is None for p in prefixes])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(extras, pa.int32()), lists], ["node", "n", "e", "prefix"]
            )

    joined = sets.select("node", "n", "zone").join(counted, "node", "left")
    return map_arrow(joined, choose, "node bigint, n bigint, e int, prefix array<bigint>")


def _compared(documents: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs ``a``, ``b``: set sizes, whether they link, and for pairs with ``wanted`` the
    shingles that only one of them has. The texts of the documents in question are met with
    the pairs; both sets are made in the same task."""
    pairs = staged(pairs, "jaccard-pairs")
    nodes = pairs.selectExpr("a AS node").unionByName(pairs.selectExpr("b AS node")).distinct()
    folder = shared_dir(documents.sparkSession, "jaccard-texts")
    _texts_of(documents, nodes).write.option("compression", "zstd").parquet(folder)
    texts = documents.sparkSession.read.schema("node bigint, text string").parquet(folder)
    met = pairs.join(texts.selectExpr("node AS a", "text AS text_a"), "a")
    met = met.join(texts.selectExpr("node AS b", "text AS text_b"), "b").select("a", "b", "text_a", "text_b", "wanted")
    names = ["a", "b", "n_a", "n_b", "linked", "apart"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.zeros(0, np.uint64)
        for batch in slices(batches, 256):
            sizes_a, sizes_b, linked, apart = [], [], [], []
            for b, text_a, text_b, wanted in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
                if (b, text_b) != last:
                    last, kept = (b, text_b), shingles(text_b, words)
                own = shingles(text_a, words)
                shared = len(np.intersect1d(own, kept, assume_unique=True))
                sizes_a.append(len(own))
                sizes_b.append(len(kept))
                linked.append(bool(shared) and 100 * shared >= percent * (len(own) + len(kept) - shared))
                apart.append(_signed(np.setxor1d(own, kept, assume_unique=True)) if wanted else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes_a, pa.int64()), pa.array(sizes_b, pa.int64()),
                 pa.array(linked), _lists(apart)], names,
            )

    return map_arrow(
        met, compare, "a bigint, b bigint, n_a bigint, n_b bigint, linked boolean, apart array<bigint>"
    )


def _verified(documents: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, as edges ``u``, ``v``."""
    compared = _compared(documents, pairs.withColumn("wanted", F.lit(False)), words, percent)
    return compared.where("linked").selectExpr("a AS u", "b AS v")


def _first_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Every class with the neighbour that is the smallest holder of most of its shingles."""
    near = posts.where("node <> hub").where(_close("n", "hub_n", percent))
    shared = near.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("e", "hub_e")).alias("e"))
    best = shared.where("c > e").groupBy("node").agg(F.max(F.struct("c", F.expr("-hub").alias("h"))).alias("best"))
    return best.selectExpr("node AS a", "-best.h AS b")


def _close(one: str, other: str, percent: int) -> str:
    """Sizes that a linked pair can have."""
    return f"100 * least({one}, {other}) >= {percent} * greatest({one}, {other})"


def _later_pairs(posts: DataFrame, first: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All candidates that lie in different components."""
    named = posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("t").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    named = staged(named.join(mixed.select("t", "low"), "t").select("t", "node", "n", "e", "df", "label", "low"), "jaccard-mixed")
    one = named.selectExpr("t", "node AS a", "n AS n_a", "e AS e_a", "label AS label_a", "df", "low")
    other = named.selectExpr("t", "node AS b", "n AS n_b", "e AS e_b", "label AS label_b")
    apart = F.expr("label_a <> label_b") & F.expr(_close("n_a", "n_b", percent))
    few = one.where(f"df <= {FEW}").join(other, "t").where("a < b").where(apart)
    few = few.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("e_a", "e_b")).alias("e"))
    # The smallest label stands for the main component; the others meet all holders, but for
    # those that were compared with the same hub: their differences from it decide.
    hubs = first.select("a", "b").groupBy("a").agg(F.min("b").alias("hub"))
    one = one.join(hubs.withColumnRenamed("hub", "hub_a"), "a", "left")
    other = other.join(hubs.selectExpr("a AS b", "hub AS hub_b"), "b", "left")
    strange = F.expr(
        "coalesce(hub_a, a) <> coalesce(hub_b, b) AND coalesce(hub_a <> b, true) AND coalesce(hub_b <> a, true)"
    )
    # A pair with several common shingles is made at the first of them, as far as both sides'
    # ``head`` tells, and from one side only.
    heads = named.where(f"df > {FEW}").groupBy("node").agg(F.expr(f"slice(array_sort(collect_list(t)), 1, {HEAD})").alias("head"))
    heads = staged(heads, "jaccard-heads")
    crowd = one.where(f"df > {FEW} AND label_a <> low").join(heads.selectExpr("node AS a", "head AS head_a"), "a")
    met = other.join(heads.selectExpr("node AS b", "head AS head_b"), "b")
    once = F.expr("(label_b = low OR a < b) AND NOT exists(array_intersect(head_a, head_b), x -> x < t)")
    many = crowd.join(met, "t").where(apart).where(strange).where(once)
    many = many.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    near = _near_one_hub(first, labels, percent)
    return few.where("c > e").select("a", "b").unionByName(many).unionByName(near).distinct()


def _near_one_hub(first: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Candidates in different components among documents compared with the same hub.

    Let d be the shingles in which a document differs from the hub, and B the most in which a
    linked pair of sizes n, n' may differ, ``c * (n + n')``. What two documents differ in is
    ``|d| + |d'| - 2 |d and d'|``. Two that both link to the hub are in one component, so one
    of a pair is further than B from it, and a link asks for more than ``|d| * (1 - c) / 2``
    shared differences on either side, and for ``|d| - B`` on the far one's side. Prefixes of
    the differences, rarest first, that long less one, must therefore meet.
    """
    c = f"({100 - percent}D / {100 + percent}D)"
    held = first.where("size(apart) > 0").selectExpr("a AS x", "b AS h", "n_a AS n", "linked", "apart", "size(apart) AS d")
    held = held.join(labels.selectExpr("node AS x", "label"), "x", "left").withColumn("label", F.coalesce("label", "x"))
    widest = f"int(floor({c} * (n + floor(n * 100D / {percent}D)) + 1e-9D))"
    held = held.selectExpr(
        "*", f"d - int(floor(d * (1D - {c}) / 2D - 1e-9D)) AS half", f"d - greatest(1, d - {widest}) + 1 AS long"
    )
    shingle = held.selectExpr("h", "x", "n", "label", "linked", "d", "half", "greatest(half, long) AS long", "explode(apart) AS t")
    counts = shingle.groupBy("h", "t").agg(F.count(F.lit(1)).alias("df"))
    # A document's differences are at most its own and the hub's shingles.
    ordered = shingle.join(counts.where("df > 1"), ["h", "t"], "left").withColumn(
        "at", F.row_number().over(Window.partitionBy("h", "x").orderBy(F.coalesce("df", F.lit(1)), "t"))
    )
    prefixes = staged(ordered.where("df > 1 AND at <= long"), "jaccard-near")
    far = prefixes.where("NOT linked").selectExpr(
        "h", "t", "x AS a", "n AS n_a", "label AS label_a", "d AS d_a", "at AS at_a", "at <= half AS early"
    )
    any_ = prefixes.where("at <= half").selectExpr(
        "h", "t", "x AS b", "n AS n_b", "label AS label_b", "d AS d_b", "at AS at_b", "linked AS near"
    )
    met = far.join(any_, ["h", "t"]).where("label_a <> label_b AND (near OR early AND a < b)")
    # From a pair's first shared difference on, enough must be left on both sides.
    enough = f"1 + least(d_a - at_a, d_b - at_b) >= (d_a + d_b - {c} * (n_a + n_b)) / 2D - 1e-9D"
    met = met.where(enough).where(_close("n_a", "n_b", percent))
    return met.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def _chosen(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The shingles that count in an estimate, and the prefixes as far as the zones tell."""
    # Exact counts, combined map-side; only shingles that count in an estimate are kept.
    counts = classes.select(F.explode("zone").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    frequent = staged(counts.where(f"df >= {COUNTED}"), "jaccard-frequent")
    return frequent, staged(_prefixes(classes, frequent, percent, whole=False), "jaccard-prefixes")


def _tokens(documents: DataFrame, frequent: DataFrame, chosen: DataFrame, words: int, percent: int) -> DataFrame:
    """``node``, ``n``, ``e`` and ``t`` for every shingle of every prefix."""
    short = chosen.where("prefix IS NULL").select("node").distinct()
    longer = _whole_sets(documents, short, words)
    longer = staged(longer, "jaccard-whole")
    lengthened = _prefixes(longer, frequent, percent, whole=True)
    prefixes = chosen.where("prefix IS NOT NULL").unionByName(lengthened)
    return staged(prefixes.select("node", "n", "e", F.explode("prefix").alias("t")), "jaccard-tokens")


def _posts(tokens: DataFrame) -> DataFrame:
    """The tokens that several classes hold, with the number of holders and the smallest one."""
    hub = F.min(F.struct("node", "n", "e")).alias("hub")
    holders = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df"), hub).where("df > 1")
    posts = tokens.join(holders, "t").selectExpr(
        "t", "node", "n", "e", "df", "hub.node AS hub", "hub.n AS hub_n", "hub.e AS hub_e"
    )
    return staged(posts, "jaccard-posts")


def _narrow_and_classes(documents: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All rows by their sets, and the sets' classes with their zones."""
    folder = shared_dir(documents.sparkSession, "jaccard-sets")
    _sets(documents, words, percent).write.option("compression", "zstd").parquet(folder)
    stored = documents.sparkSession.read.schema(
        "doc_id bigint, n bigint, s1 bigint, s2 bigint, zone array<bigint>"
    ).parquet(folder)
    narrow = staged(stored.select("doc_id", "n", "s1", "s2"), "jaccard-narrow")
    held = stored.where("n > 0 AND doc_id IS NOT NULL")
    classes = held.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("node"), F.first("zone").alias("zone"))
    return narrow, staged(classes, "jaccard-classes")


def _narrow_and_posts(documents: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows by their sets, the sets' classes, and the posts."""
    spark = documents.sparkSession
    # Sets, zones, prefixes and tokens are each about as large as the next; no two steps' are kept.
    with consumed(spark, "jaccard-narrow", "jaccard-names", "jaccard-tokens"):
        with consumed(spark, "jaccard-narrow", "jaccard-names", "jaccard-frequent", "jaccard-prefixes"):
            with consumed(spark, "jaccard-narrow", "jaccard-classes"):
                narrow, classes = _narrow_and_classes(documents, words, percent)
            names = staged(classes.drop("zone"), "jaccard-names")
            frequent, chosen = _chosen(classes, percent)
        tokens = _tokens(documents, frequent, chosen, words, percent)
    return narrow, names, _posts(tokens)


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest linked ``doc_id``) of every row."""
    with consumed(documents.sparkSession, "jaccard-narrow", "jaccard-labels"):
        return _components(documents, words, percent)


def _components(documents: DataFrame, words: int, percent: int) -> DataFrame:
    # Tokens, many times the size of what follows, are not kept beyond the posts.
    with consumed(documents.sparkSession, "jaccard-narrow", "jaccard-names", "jaccard-posts"):
        narrow, names, posts = _narrow_and_posts(documents, words, percent)
    crowded = posts.where(f"df > {FEW}").select(F.col("node").alias("a")).distinct().withColumn("wanted", F.lit(True))
    pairs = _first_pairs(posts, percent).join(crowded, "a", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    first = staged(_compared(documents, pairs, words, percent), "jaccard-first")
    links = first.where("linked").selectExpr("a AS u", "b AS v")
    labels = components(links)
    later = _verified(documents, _later_pairs(posts, first, labels, percent), words, percent)
    links = links.unionByName(later)
    # A row of another set under a node's id belongs to the node as well.
    held = narrow.where("n > 0 AND doc_id IS NOT NULL")
    alias = held.join(names, ["n", "s1", "s2"])
    alias = alias.where("doc_id <> node").selectExpr("doc_id AS u", "node AS v")
    labels = staged(components(links.unionByName(alias)), "jaccard-labels")
    named = narrow.withColumnRenamed("n", "n_shingles").join(labels, narrow["doc_id"] == labels["node"], "left")
    return named.selectExpr(
        "doc_id", "n_shingles", "CASE WHEN n_shingles = 0 THEN doc_id ELSE coalesce(label, doc_id) END AS component_id"
    )


def without(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id is not among ``gone_id``, in their own columns."""
    gone = staged(gone.select("gone_id"), "jaccard-gone")
    gone = broadcast_if(fits(gone), gone)
    return documents.join(gone, documents["doc_id"].cast("bigint") == gone["gone_id"], "left_anti")
