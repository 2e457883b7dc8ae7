from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from quotelake.operators import parse

GOOD = (
    '[{"ticker":"QLX","date":"2023-11-08","open":7.25,"high":9,"low":6,"close":8,"volume":4200}]'
)

# content, number of quotes, reason; one row per literal record.
RECORDS = [
    ("YahooFinance", GOOD, 1, None),
    ("YahooFinance", '[{"ticker":"QLX","date":"2023-11-08","close":31},{"ticker":"ZORB","date":"2023-11-08","close":17}]', 2, None),
    ("YahooFinance", "{no json", 0, "bad_json"),
    ("YahooFinance", '[{"ticker":" ","date":"2023-11-08","close":3}]', 0, None),
    ("YahooFinance", '[{"ticker":"QLX","date":"someday","close":5}]', 0, None),
    ("YahooFinance", '[{"ticker":"QLX","date":"2023-11-08"}]', 1, None),
    ("CoinGecko", '{"ticker":"QLX","date":"2023-11-08","close":64}', 1, None),
    ("NoSuchFeed", GOOD, 0, "unknown_source"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","close":1},{"date":"2023-11-08","close":2}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","close":null}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","close":"12.5"}]', 0, "bad_element"),
    (" yahoofinance", GOOD, 1, None),
    ("YahooFinance", "[]", 0, None),
    ("YahooFinance", '[{"ticker":null,"date":"2023-11-08"}]', 0, None),
    ("YahooFinance", '[{"ticker":"","date":"2023-11-08","close":null}]', 0, None),
    # Beyond the literal fixtures.
    ("YahooFinance", GOOD + " x", 0, "bad_json"),
    ("YahooFinance", GOOD + GOOD, 0, "bad_json"),
    ("YahooFinance", GOOD + "," + GOOD, 0, "bad_json"),
    ("YahooFinance", GOOD + "]", 0, "bad_json"),
    ("YahooFinance", "", 0, "bad_json"),
    ("YahooFinance", None, 0, "bad_json"),
    ("YahooFinance", "null", 0, "bad_element"),
    ("YahooFinance", "5", 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08"}, 7]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08"}, [1]]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":5,"date":"2023-11-08"}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":20231108}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A"}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":null}]', 0, None),
    ("YahooFinance", '[{"ticker":"A","date":"2024-1-5","close":true}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2024-1-5","close":1e3}]', 1, None),
    ("YahooFinance", '[{"ticker":"A","date":"2024-1-5","close":1e40}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2024"}]', 0, None),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08T10:00"}]', 0, None),
    ("YahooFinance", '[{"ticker":"A","date":"2024-02-30"}]', 0, None),
    ("YahooFinance", '[{"ticker":" \\t\\u2003","date":"2023-11-08"}]', 0, None),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","close":{"x":1}}]', 0, "bad_element"),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","extra":{"close":"x"}}]', 1, None),
    ("YahooFinance", '[{"ticker":"A","date":"2023-11-08","close":1,"close":2}]', 1, None),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    from quotelake import schemas as S

    rows = [
        (number, source, source, content, dt.datetime(2024, 6, 1), False)
        for number, (source, content, _, _) in enumerate(RECORDS)
    ]
    return parse.record_outcomes(spark.createDataFrame(rows, S.LAKE)).cache()


def test_record_outcomes(outcomes):
    reasons = {row.record_id: row.reason for row in outcomes.collect()}
    assert reasons == {number: reason for number, (_, _, _, reason) in enumerate(RECORDS)}


def test_quote_counts(outcomes):
    counts = {
        row.record_id: row["count"] for row in parse.parsed_quotes(outcomes).groupBy("record_id").count().collect()
    }
    assert counts == {number: count for number, (_, _, count, _) in enumerate(RECORDS) if count}


def test_values(outcomes):
    quotes = {(row.record_id, row.element_pos): row for row in parse.parsed_quotes(outcomes).collect()}
    first = quotes[0, 0]
    assert (first.ticker, first.date, first.source) == ("QLX", dt.date(2023, 11, 8), "YahooFinance")
    assert [first.open, first.high, first.low, first.close] == [Decimal("7.25"), 9, 6, 8]
    assert first.volume == 4200
    assert [quotes[1, n].ticker for n in (0, 1)] == ["QLX", "ZORB"]
    empty = quotes[5, 0]
    assert {empty.open, empty.high, empty.low, empty.close, empty.volume} == {Decimal(0)}
    assert quotes[11, 0].source == "YahooFinance"
    repeated_key = quotes[len(RECORDS) - 1, 0]
    assert repeated_key.close == 2


def test_rejects_cover_exactly_the_rejected(outcomes):
    found = {(row.record_id, row.element_pos, row.reason) for row in parse.rejects(outcomes).collect()}
    assert found == {(n, None, reason) for n, (_, _, _, reason) in enumerate(RECORDS) if reason}
    accepted = {row.record_id for row in parse.accepted_ids(outcomes).collect()}
    assert accepted == {n for n, (_, _, _, reason) in enumerate(RECORDS) if not reason}


def test_number_beyond_its_column_rejects_only_the_element(lake):
    outcomes = parse.record_outcomes(
        lake(
            (
                "CoinGecko",
                '[{"ticker":"A","date":"2023-11-08","close":10000000000},'
                '{"ticker":"A","date":"2024-01-16","close":9999999999.123456789},'
                '{"ticker":" ","date":"2024-01-16","close":10000000000}]',
            )
        )
    )
    quotes = parse.parsed_quotes(outcomes).collect()
    assert [(row.element_pos, row.close) for row in quotes] == [(1, Decimal("9999999999.12345679"))]
    assert [tuple(row) for row in parse.rejects(outcomes).collect()] == [(1, "CoinGecko", 0, "out_of_range")]
    counts = parse.outcome_counts(outcomes).first()
    assert (counts.records_processed, counts.quotes_parsed, counts.elements_skipped, counts.elements_rejected) == (1, 1, 1, 1)


def test_no_records(lake, spark):
    empty = lake(("YahooFinance", GOOD)).where("false")
    outcomes = parse.record_outcomes(empty)
    assert parse.parsed_quotes(outcomes).count() == 0
    assert parse.outcome_counts(outcomes).first().records == 0


def test_json_is_parsed_once(lake, capsys):
    parse.parsed_quotes(parse.record_outcomes(lake(("YahooFinance", GOOD)))).explain()
    assert capsys.readouterr().out.count("parseJson") == 1
