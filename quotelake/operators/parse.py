"""Lake records to typed quotes, with whole-record rejects.

Every decision about a record is taken inside its own row, so parsing needs no exchange
whatever share of the records one source or ticker holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake import schemas as S
from quotelake.functions import variants as V
from quotelake.functions.calendar import iso_date
from quotelake.operators.once import named_struct as _struct
from quotelake.operators.once import once

UNKNOWN_SOURCE = "unknown_source"
BAD_JSON = "bad_json"
BAD_ELEMENT = "bad_element"
BAD_PAYLOAD = "bad_payload"
OUT_OF_RANGE = "out_of_range"
TOO_LONG = "too_long"

NUMBERS = {"open": S.PRICE, "high": S.PRICE, "low": S.PRICE, "close": S.PRICE, "volume": S.VOLUME}


def known_source(source: str) -> str:
    """The canonical name of a source, whatever its case; null when unknown."""
    cases = " ".join(f"WHEN '{name.lower()}' THEN '{name}'" for name in S.SOURCES)
    return f"CASE lower(trim({source})) {cases} END"


KEYS = ("ticker", "date", *NUMBERS)

# The fields of one JSON element ``e`` as far as their types allow, each number with its
# type name and, should it not fit its column, with itself.
_READ = _struct(
    element_pos="i",
    texts=f"coalesce({V.is_text('e.ticker')} AND {V.is_text('e.date')}, false)",
    ticker=V.read("e.ticker", "$", "string"),
    day=V.read("e.date", "$", "string"),
    **{name: V.read(f"e.{name}", "$", kind.simpleString()) for name, kind in NUMBERS.items()},
    **{f"{name}_type": V.type_of(f"e.{name}") for name in NUMBERS},
    **{f"{name}_raw": f"e.{name}" for name in NUMBERS},
)


def _is_number(name: str) -> str:
    """A missing number passes; the range is looked at only where the column was too small."""
    given = f"e.{name} IS NOT NULL OR {V.in_decimal_range(f'e.{name}_raw')}"
    return f"(e.{name}_type IS NULL OR ({V.is_number_type(f'e.{name}_type')} AND ({given})))"


# Usable text fields, and whether every number present is a number and fits its column.
_TYPED = _struct(
    element_pos="e.element_pos",
    texts="e.texts",
    ticker="e.ticker",
    date=iso_date("e.day"),
    **{name: f"coalesce(e.{name}, CAST(0 AS {kind.simpleString()}))" for name, kind in NUMBERS.items()},
    numeric=" AND ".join(_is_number(name) for name in NUMBERS),
    fits=" AND ".join(f"(e.{name}_type IS NULL OR e.{name} IS NOT NULL)" for name in NUMBERS),
)

# Numbers only count where ticker and date are usable.
_BLANK = r"coalesce(e.ticker RLIKE '(?U)^\\s*$', true)"
_WANTED = f"(e.texts AND NOT {_BLANK} AND e.date IS NOT NULL)"
_JUDGED = _struct(
    element_pos="e.element_pos",
    ticker="e.ticker",
    date="e.date",
    **{name: f"e.{name}" for name in NUMBERS},
    wanted=_WANTED,
    bad=f"(NOT e.texts OR ({_WANTED} AND NOT e.numeric))",
    unfit=f"CASE WHEN {_WANTED} AND e.numeric THEN CASE WHEN NOT e.fits THEN '{OUT_OF_RANGE}' "
    f"WHEN char_length(e.ticker) > {S.MAX_LENGTH['dim_assets']['ticker']} THEN '{TOO_LONG}' END END",
)


def record_outcomes(lake: DataFrame) -> DataFrame:
    """One row per lake record: its source, its elements, or the reason for its reject."""
    known = lake.selectExpr(
        "record_id", "loaded_at", "raw_content",
        # A payload its normaliser refused was landed without content, its id in the endpoint.
        "coalesce(raw_content IS NULL AND startswith(endpoint, concat(source, '/')), false) AS refused",
        "source AS given_source", f"{known_source('source')} AS known_source",
    )
    # A record of an unknown source is rejected unread.
    text = "CASE WHEN known_source IS NOT NULL THEN raw_content END"
    parsed = once(known, wrapped=V.parse_with_end(text))
    parsed = once(parsed, root=V.only_value("wrapped"))
    elements = f"coalesce({V.members('root', KEYS, many=True)}, array({V.members('root', KEYS)}))"
    for shape in (f"(e, i) -> {_READ}", f"e -> {_TYPED}", f"e -> {_JUDGED}"):
        elements = f"transform({elements}, {shape})"
    parsed = once(parsed, judged=f"CASE WHEN root IS NOT NULL THEN {elements} END")
    reason = (
        f"CASE WHEN known_source IS NULL THEN '{UNKNOWN_SOURCE}' WHEN refused THEN '{BAD_PAYLOAD}' "
        f"WHEN root IS NULL THEN '{BAD_JSON}' "
        f"WHEN exists(judged, e -> e.bad) THEN '{BAD_ELEMENT}' END"
    )
    return once(parsed, reason=reason).selectExpr(
        "record_id",
        "coalesce(known_source, given_source) AS source",
        "loaded_at",
        "reason",
        "CASE WHEN reason IS NULL THEN judged END AS elements",
    )


def parsed_quotes(outcomes: DataFrame) -> DataFrame:
    """The quotes of the accepted records."""
    return (
        outcomes.selectExpr("source", "loaded_at", "record_id", "inline(elements)")
        .where("wanted AND unfit IS NULL")
        .select(*S.QUOTES.fieldNames())
    )


def rejects(outcomes: DataFrame) -> DataFrame:
    """Rejected records, and single elements no fact column can hold, with the reason."""
    whole = "array(named_struct('element_pos', CAST(NULL AS INT), 'why', reason))"
    single = (
        "transform(filter(elements, e -> e.unfit IS NOT NULL), "
        "e -> named_struct('element_pos', e.element_pos, 'why', e.unfit))"
    )
    found = f"inline(CASE WHEN reason IS NOT NULL THEN {whole} ELSE {single} END)"
    return outcomes.selectExpr("record_id", "source", found).withColumnRenamed("why", "reason")


def accepted_ids(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("reason IS NULL").select("record_id")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """The run counters of a batch of records, one row."""

    def elements_where(test: str) -> str:
        return f"coalesce(sum(size(filter(elements, e -> {test}))), 0)"

    counters = {
        "records": "count(*)",
        "records_processed": "count_if(reason IS NULL)",
        "records_rejected": "count_if(reason IS NOT NULL)",
        "quotes_parsed": elements_where("e.wanted AND e.unfit IS NULL"),
        "elements_skipped": elements_where("NOT e.wanted"),
        "elements_rejected": elements_where("e.unfit IS NOT NULL"),
    }
    return outcomes.agg(*(F.expr(counter).alias(name) for name, counter in counters.items()))


def outcomes_by_source(outcomes: DataFrame) -> DataFrame:
    """Records and quotes per source and outcome."""
    quotes = "coalesce(size(filter(elements, e -> e.wanted AND e.unfit IS NULL)), 0)"
    counted = outcomes.selectExpr(
        "source", "coalesce(reason, 'processed') AS outcome", f"{quotes} AS quotes"
    )
    return counted.groupBy("source", "outcome").agg(
        F.count("*").alias("records"), F.sum("quotes").alias("quotes")
    )
