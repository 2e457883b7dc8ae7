"""Quality rules with robust multivariate outliers, with DataFrame functions only.

Base rules count words, characters, symbols, repeated lines and repeated eight-word windows
of the whole text. Documents that pass them are judged by four transformed rates. For every
language and source the minimum-covariance-determinant estimate of centre and scatter is
sought: from two deterministic starts (medians with quartile ranges, and the plain
moments), concentration steps keep the ``SHARE`` of documents nearest to the estimate and
estimate anew from them; the start with the smaller determinant wins. A document whose
squared Mahalanobis distance exceeds the chi-square quantile ``1 - TAIL`` is rejected.

Rates are shrunk towards a common prior by ``PRIOR_WORDS`` words, so that short texts do not
stand out by chance, and the scatter's diagonal gets a floor, so that a rate that is
constant in a source does not reject the first document that differs a little. Features are
whole numbers of 1/``UNIT``, so sums are exact and the estimate does not depend on the order
of rows. The nearest share is found in steps of distance (``BINS_PER_E`` to a factor e):
sums are kept per distance step, a bounded number per group, and no group is gathered.

Every document that passes the base rules meets an estimate: that of its language and source
if these have ``LEAST`` such documents, else that of its whole language, else that of all
documents. A document is part of every estimate that its language and source lead to.

Nulls and edges: a null text has no words and fails; null languages and sources are groups
of their own; equal rows get equal verdicts; windows are compared by 64-bit hashes. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import let, words_sql
from quotelake.operators.bounded import broadcast_if, fits
from quotelake.operators.once import once
from quotelake.session import staged

# The base rules.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

UNIT = 1024
PRIOR_WORDS = 100
PRIOR_CHARS = 5
# Features as SQL over the statistics, and the floor of their standard deviation.
RATES = f"(n_words + {PRIOR_WORDS}D)"
FEATURES = {
    "x1": (f"ln((word_chars + {PRIOR_WORDS * PRIOR_CHARS}D) / {RATES})", 0.03),
    "x2": (f"ln(1D + 50D * n_symbols / {RATES})", 0.12),
    "x3": (f"ln(1D + 50D * n_dup_lines / {RATES})", 0.12),
    "x4": (f"ln(1D + 10D * n_repeat_words / {RATES})", 0.15),
}
P = len(FEATURES)
SHARE = 0.75
STEPS = 5
BINS_PER_E = 16
LEAST = 50
TAIL = 1e-6
# Estimates broadcast: at most so many groups.
MOST_GROUPS = 100_000

_PAIRS = [(i, j) for i in range(1, P + 1) for j in range(1, i + 1)]
_NAMES = list(FEATURES)


def _chi_square(x: float, degrees: int) -> float:
    """The distribution function for even degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, degrees) < share else (low, middle)
    return high


CUTOFF = quantile(1 - TAIL, P)
# Makes the scatter of the nearest share that of the whole under a normal law.
CONSISTENCY = SHARE / _chi_square(quantile(SHARE, P), P + 2)


def _repeat_words() -> str:
    window = ", ".join(f"words[i + {k}]" if k else "words[i]" for k in range(WINDOW))
    hashes = f"transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({window}))"
    pairs = "sort_array(transform(h, (x, i) -> named_struct('h', x, 'p', i)))"
    twice = "filter(s, (x, i) -> (i > 0 AND s[i - 1].h = x.h) OR (i < size(s) - 1 AND s[i + 1].h = x.h))"
    places = f"sort_array(transform({let(pairs, 's', twice)}, x -> x.p))"
    covered = (
        f"aggregate({places}, named_struct('n', 0L, 'last', -{WINDOW}), "
        f"(a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', p), a -> a.n)"
    )
    found = f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {covered} END"
    return f"CASE WHEN size(words) < {WINDOW + 1} THEN 0L ELSE {let(hashes, 'h', found)} END"


def row_key() -> F.Column:
    """Tells apart rows of one ``doc_id`` that may get different verdicts."""
    parts = [F.concat(F.lit("="), F.col(name).cast("string")) for name in ("lang", "source", "text")]
    return F.xxhash64(*(F.coalesce(part, F.lit("")) for part in parts))


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the base statistics of every document's whole text."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        row_key().alias("row_key"),
    )
    lines = "filter(split(text, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    return once(rows, words=words_sql("text")).selectExpr(
        "doc_id",
        "lang",
        "source",
        "row_key",
        "bigint(size(words)) AS n_words",
        "bigint(length(array_join(words, ''))) AS word_chars",
        f"bigint(octet_length(text) - octet_length(regexp_replace(text, '{SYMBOLS}', ''))) AS n_symbols",
        f"bigint({let(lines, 'x', 'size(x) - size(array_distinct(x))')}) AS n_dup_lines",
        f"{_repeat_words()} AS n_repeat_words",
    )


def base_rules(rows: DataFrame) -> DataFrame:
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"
    return rows.withColumn("base_failed", F.expr(failed))


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``g``, the group whose estimate judges a row: language and source, the language, or
    all; and ``parts``, the groups whose estimates the row is part of."""
    lang, source = "coalesce(concat('=', lang), '')", "coalesce(concat('=', source), '')"
    counts = rows.groupBy("lang", "source").agg(F.expr("count_if(NOT base_failed)").alias("n"))
    # One row per language and source.
    counts = staged(counts.withColumn("in_lang", F.expr("sum(n) OVER (PARTITION BY lang)")), "mcd-counts")
    named = counts.selectExpr(
        "lang AS l", "source AS s",
        f"concat({lang}, '\\u0001', {source}) AS own_g", f"concat({lang}, '\\u0002') AS lang_g",
        f"CASE WHEN n >= {LEAST} THEN 1 WHEN in_lang >= {LEAST} THEN 2 ELSE 3 END AS level",
    ).selectExpr("*", "CASE level WHEN 1 THEN own_g WHEN 2 THEN lang_g ELSE '' END AS g")
    in_all = str(not named.where("level = 3").isEmpty()).lower()
    named = named.selectExpr("*", "max(level = 2) OVER (PARTITION BY l) AS in_language", f"{in_all} AS in_all")
    parts = "filter(array(IF(level = 1, own_g, NULL), IF(in_language, lang_g, NULL), IF(in_all, '', NULL)), x -> x IS NOT NULL)"
    named = staged(named.selectExpr("l", "s", "g", f"{parts} AS parts"), "mcd-groups")
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(broadcast_if(fits(named, MOST_GROUPS), named), same, "left").drop("l", "s")


def _solved(rows: DataFrame) -> DataFrame:
    """From means ``m*`` and scatter ``c*`` the Cholesky factor ``l*`` and the log determinant."""
    for j in range(1, P + 1):
        inner = "".join(f" - l{j}{k} * l{j}{k}" for k in range(1, j))
        rows = rows.withColumn(f"l{j}{j}", F.expr(f"sqrt(greatest(c{j}{j}{inner}, 1e-9D))"))
        for i in range(j + 1, P + 1):
            inner = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            rows = rows.withColumn(f"l{i}{j}", F.expr(f"(c{i}{j}{inner}) / l{j}{j}"))
    log_det = " + ".join(f"2 * ln(l{j}{j})" for j in range(1, P + 1))
    factors = [f"m{i}" for i in range(1, P + 1)] + [f"l{i}{j}" for i, j in _PAIRS]
    return rows.selectExpr("g", "start", *factors, f"{log_det} AS log_det")


def _estimated(sums: DataFrame, factor: float) -> DataFrame:
    """Estimates from the exact sums ``n``, ``s*`` and ``s**`` of each group and start."""
    means = [f"s{i} / n AS m{i}" for i in range(1, P + 1)]
    scatter = []
    for i, j in _PAIRS:
        floor = f" + {(FEATURES[_NAMES[i - 1]][1] * UNIT) ** 2!r}D" if i == j else ""
        scatter.append(f"{factor!r}D * (s{i}{j} / n - (s{i} / n) * (s{j} / n)){floor} AS c{i}{j}")
    return _solved(sums.where("n > 0").selectExpr("g", "start", *means, *scatter))


def _sums() -> list[F.Column]:
    first = [F.sum(name).alias(f"s{k}") for k, name in enumerate(_NAMES, start=1)]
    second = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _PAIRS]
    return [F.count(F.lit(1)).alias("n"), *first, *second]


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i in range(1, P + 1):
        inner = "".join(f" - l{i}{k} * z{k}" for k in range(1, i))
        rows = rows.withColumn(f"z{i}", F.expr(f"(x{i} - m{i}{inner}) / l{i}{i}"))
    return rows.withColumn("d2", F.expr(" + ".join(f"z{i} * z{i}" for i in range(1, P + 1))))


def _quartile_start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges, from counts of feature values; a group has few values."""
    values = rows.select("g", F.expr("inline(array(" + ", ".join(
        f"named_struct('f', {k}, 'x', {name})" for k, name in enumerate(_NAMES, start=1)) + "))"))
    counts = values.groupBy("g", "f", "x").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy("g", "f")
    running = counts.withColumn("to", F.sum("n").over(window.orderBy("x"))).withColumn("all", F.sum("n").over(window))
    at = [F.min(F.expr(f"CASE WHEN to >= {q} * all THEN x END")).alias(name) for q, name in (("0.25", "a"), ("0.5", "b"), ("0.75", "c"))]
    quartiles = running.groupBy("g", "f").agg(*at)
    wide = quartiles.groupBy("g").agg(
        *(F.max(F.expr(f"CASE WHEN f = {k} THEN double(b) END")).alias(f"m{k}") for k in range(1, P + 1)),
        *(F.max(F.expr(f"CASE WHEN f = {k} THEN (c - a) / 1.349D END")).alias(f"r{k}") for k in range(1, P + 1)),
    )
    scatter = [
        f"r{i} * r{i} + {(FEATURES[_NAMES[i - 1]][1] * UNIT) ** 2!r}D AS c{i}{i}" if i == j else f"0D AS c{i}{j}"
        for i, j in _PAIRS
    ]
    return _solved(wide.selectExpr("g", "1 AS start", *(f"m{i}" for i in range(1, P + 1)), *scatter))


def _joined(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    return rows.join(broadcast_if(fits(estimates, MOST_GROUPS), estimates), "g", how)


def estimates(rows: DataFrame) -> DataFrame:
    """One estimate per group of ``rows`` (stored, with ``g`` and the features)."""
    plain = _estimated(rows.groupBy("g").agg(*_sums()).withColumn("start", F.lit(2)), 1.0)
    current = staged(_quartile_start(rows).unionByName(plain), "mcd-starts")
    nearest = Window.partitionBy("g", "start")
    for _ in range(STEPS):
        near = _distance(_joined(rows, current)).withColumn("bin", F.expr(f"int(floor({BINS_PER_E} * ln(d2 + 1e-6D)))"))
        steps = near.groupBy("g", "start", "bin").agg(*_sums())
        steps = steps.withColumn("before", F.sum("n").over(nearest.orderBy("bin")) - F.col("n"))
        steps = steps.withColumn("all", F.sum("n").over(nearest)).where(f"before < {SHARE} * all")
        names = ["n", *(f"s{i}" for i in range(1, P + 1)), *(f"s{i}{j}" for i, j in _PAIRS)]
        sums = steps.groupBy("g", "start").agg(*(F.sum(name).alias(name) for name in names))
        current = staged(_estimated(sums, CONSISTENCY), "mcd-step")
    order = F.row_number().over(Window.partitionBy("g").orderBy("log_det", "start"))
    return staged(current.withColumn("k", order).where("k = 1").drop("k", "start"), "mcd")


def judged(documents: DataFrame) -> DataFrame:
    """All statistics with ``base_failed``, the distance ``d2`` (null without estimate) and ``kept``."""
    features = [f"bigint(round({formula} * {UNIT})) AS {name}" for name, (formula, _) in FEATURES.items()]
    rows = staged(base_rules(statistics(documents)).selectExpr("*", *features), "mcd-statistics")
    rows = _grouped(rows)
    sound = staged(rows.where("NOT base_failed").select(F.explode("parts").alias("g"), *_NAMES), "mcd-rows")
    measured = _distance(_joined(rows, estimates(sound), "left"))
    return measured.selectExpr(
        "doc_id", "lang", "source", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "CASE WHEN base_failed THEN NULL ELSE d2 END AS d2",
        f"NOT base_failed AND coalesce(d2 <= {CUTOFF!r}D, true) AS kept",
    )


def good_documents(documents: DataFrame) -> DataFrame:
    """The documents that are kept, in their own columns and number."""
    bad = staged(judged(documents).where("NOT kept").select("doc_id", "row_key").distinct(), "mcd-rejected")
    held = documents.select(
        F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("held"),
        F.col("doc_id").cast("bigint").alias("held_id"), row_key().alias("held_key"),
    )
    same = F.expr("held_id <=> doc_id AND held_key = row_key")
    return held.join(broadcast_if(fits(bad), bad), same, "left_anti").select("held.*")
