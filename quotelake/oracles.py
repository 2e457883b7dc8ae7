"""The SQL that each query is checked against.

Written apart from the Spark plans: sorted lists where the plan ranks or aggregates, windows
where it keeps first rows, and whole-number arithmetic where it rounds decimals.
"""

from __future__ import annotations

PIVOT_DAYS = 90

# Order lines as quotes, with their position in the batch among equal keys.
QUOTES = """
quotes AS (
  SELECT l_partkey AS asset_key,
         l_shipdate::DATE AS d,
         year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS date_key,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS source_key,
         l_returnflag AS source,
         'P' || l_partkey AS ticker,
         l_extendedprice::DECIMAL(12,2) AS close,
         l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)) AS low,
         l_extendedprice::DECIMAL(12,2) * (1 + l_tax::DECIMAL(4,2)) AS high,
         l_quantity AS volume,
         l_shipdate + l_linenumber * INTERVAL 1 DAY AS loaded_at,
         l_orderkey AS record_id,
         l_linenumber AS element_pos,
         l_linestatus AS status, l_extendedprice, l_quantity, l_discount, l_tax
  FROM lineitem)"""

BATCH_ORDER = "loaded_at, record_id, element_pos, l_extendedprice, l_quantity, l_discount, l_tax"
BATCH_ORDER_DOWN = ", ".join(f"{name} DESC" for name in BATCH_ORDER.split(", "))
ID = "asset_key * 4294967296 + (d - DATE '0001-01-01') * 1024 + source_key"

FACTS = f"""{QUOTES},
facts AS (
  SELECT *, {ID} AS id FROM quotes
  QUALIFY row_number() OVER (PARTITION BY asset_key, d, source_key ORDER BY {BATCH_ORDER}) = 1)"""

# Facts of the lines from the third on, with the number of lines up to the fourth of their key.
OVERLAPPING = f"""
keyed AS (
  SELECT *, {ID} AS id, count(*) FILTER (WHERE element_pos <= 4) OVER (PARTITION BY asset_key, d, source_key) AS n_stored
  FROM quotes),
incoming AS (
  SELECT * FROM keyed WHERE element_pos >= 3
  QUALIFY row_number() OVER (PARTITION BY asset_key, d, source_key ORDER BY {BATCH_ORDER}) = 1)"""

ASSETS = """
assets AS (
  SELECT p_partkey AS asset_key, 'P' || p_partkey AS ticker, p_name AS name,
         p_type AS asset_type, p_size >= 6 AS is_active
  FROM part)"""

FACT_COLUMNS = """
  id, asset_key, date_key, source_key,
  low::DOUBLE AS open_price, high::DOUBLE AS high_price, low::DOUBLE AS low_price,
  close::DOUBLE AS close_price, volume::DOUBLE AS volume,
  strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at"""


def cents(value: str) -> str:
    return f"({value} * 100)::HUGEINT"


def ratio(top: str, bottom: str) -> str:
    """100 * top / bottom, half-up to two places, in whole numbers."""
    scaled = f"((abs({top}) * 20000 + {bottom}) // (2 * {bottom}))"
    return f"(sign({top}) * {scaled})::DOUBLE / 100"


def change(now: str, before: str) -> str:
    return (
        f"CASE WHEN {before} IS NULL OR {before} = 0 THEN 0.0 "
        f"ELSE {ratio(f'({cents(now)} - {cents(before)})', cents(before))} END"
    )


# One close per day, then the two newest of each list.
SUMMARY = f"""{FACTS}, {ASSETS},
day_closes AS (SELECT asset_key, d, arg_min(close, source_key) AS close FROM facts GROUP BY ALL),
ordered AS (SELECT asset_key, list(close ORDER BY d DESC) AS closes FROM day_closes GROUP BY asset_key),
summary AS (
  SELECT a.ticker, a.name, a.asset_type, closes[1] AS last_close, closes[2] AS previous_close
  FROM assets a JOIN ordered USING (asset_key) WHERE a.is_active)"""

SUMMARY_BY_ROW = f"""{FACTS}, {ASSETS},
ordered AS (
  SELECT asset_key, list(close ORDER BY d DESC, source_key) AS closes FROM facts GROUP BY asset_key),
summary AS (
  SELECT a.ticker, a.name, a.asset_type, closes[1] AS last_close, closes[2] AS previous_close
  FROM assets a JOIN ordered USING (asset_key) WHERE a.is_active)"""

SUMMARY_SELECT = f"""
SELECT ticker, name, asset_type, last_close::DOUBLE AS last_close,
       coalesce(previous_close, 0)::DOUBLE AS previous_close,
       {change('last_close', 'previous_close')} AS change_percent
FROM summary ORDER BY ticker"""

DAILY_SELECT = f"""
SELECT ticker, name, asset_type, last_close::DOUBLE AS close_price,
       {change('last_close', 'previous_close')} AS change_percent
FROM summary ORDER BY ticker"""

# The newest rows of every active asset.
HISTORY = f"""{FACTS}, {ASSETS},
history AS (
  SELECT a.asset_key, a.ticker, f.d, f.close, f.low, f.high, f.volume, f.source_key,
         row_number() OVER (PARTITION BY a.ticker ORDER BY f.d DESC, f.source_key) AS nth
  FROM facts f JOIN assets a USING (asset_key) WHERE a.is_active)"""

HISTORY_COLUMNS = """
  asset_key, ticker, strftime(d, '%Y-%m-%d') AS date, low::DOUBLE AS open, high::DOUBLE AS high,
  low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume, source_key"""


def compared(days: int) -> str:
    return f"""{FACTS}, {ASSETS},
in_range AS (
  SELECT a.ticker, f.d, f.source_key, f.close FROM facts f JOIN assets a USING (asset_key)
  WHERE a.is_active AND f.d >= (SELECT max(l_shipdate)::DATE FROM lineitem) - {days}),
bases AS (
  SELECT ticker, {cents('list(close ORDER BY d, source_key)[1]')} AS base FROM in_range GROUP BY ticker),
based AS (SELECT * FROM in_range JOIN bases USING (ticker)),
compared AS (
  SELECT *, CASE WHEN base = 0 THEN 0.0 ELSE {ratio(cents('close'), 'base')} END AS normalized_return
  FROM based),
daily AS (
  SELECT ticker, d, normalized_return FROM compared
  QUALIFY row_number() OVER (PARTITION BY ticker, d ORDER BY source_key DESC) = 1)"""


COMPARED_SELECT = """
SELECT ticker, strftime(d, '%Y-%m-%d') AS date, close::DOUBLE AS close, normalized_return
FROM compared"""

WEEK52 = f"""{FACTS}, {ASSETS},
closes AS (
  SELECT asset_key, list(close ORDER BY d DESC, source_key)[1] AS last_close,
         list(close) FILTER (WHERE d >= (SELECT max(l_shipdate)::DATE FROM lineitem) - 365) AS year
  FROM facts GROUP BY asset_key),
spans AS (SELECT *, list_max(year) AS high, list_min(year) AS low FROM closes),
screener AS (
  SELECT ticker, name, asset_type, last_close,
         ifnull(high, last_close) AS high_52w, ifnull(low, last_close) AS low_52w,
         {change('last_close', 'high')} AS pct_from_high,
         {change('last_close', 'low')} AS pct_from_low
  FROM spans JOIN assets USING (asset_key) WHERE is_active)"""

# Half-to-even of 100 * (last - low) / (high - low) in whole numbers.
_TOP = cents("(last_close - low_52w)") + " * 100"
_SPAN = cents("(high_52w - low_52w)")
PLACED = f"""{WEEK52},
parts AS (
  SELECT *, {_SPAN} AS span, CASE WHEN {_SPAN} > 0 THEN {_TOP} // {_SPAN} END AS whole,
         CASE WHEN {_SPAN} > 0 THEN 2 * ({_TOP} % {_SPAN}) END AS rest
  FROM screener),
placed AS (
  SELECT * EXCLUDE (span, whole, rest),
         CASE WHEN span = 0 THEN 50
              WHEN rest > span OR (rest = span AND whole % 2 = 1) THEN whole + 1
              ELSE whole END::INTEGER AS position
  FROM parts)"""
BAND = "CASE WHEN position >= 70 THEN 'high' WHEN position >= 30 THEN 'middle' ELSE 'low' END"


def grouped(value: str, places: int = 2) -> str:
    return f"format('{{:,.{places}f}}', ({value})::DOUBLE)"


def signed(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN '+' ELSE '' END || {grouped(value)} || '%'"


CALENDAR = """
  year(d) * 10000 + month(d) * 100 + day(d) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
  year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
  dayofweek(d) AS day_of_week, weekofyear(d) AS week_of_year, isodow(d) >= 6 AS is_weekend"""

# Events as lake records, and what becomes of each.
LAKE = """
lake AS (
  SELECT event_id AS record_id, event_type, ts, user_id,
         CASE event_type WHEN 'click' THEN 'yahoofinance' WHEN 'view' THEN 'UnknownFeed'
              WHEN 'signup' THEN 'CoinGecko' ELSE 'YahooFinance' END AS source,
         CASE event_type WHEN 'view' THEN 'unknown_source' WHEN 'error' THEN 'bad_json'
              WHEN 'purchase' THEN 'bad_element' END AS reason,
         CASE event_type WHEN 'signup' THEN 'CoinGecko' WHEN 'view' THEN 'UnknownFeed'
              ELSE 'YahooFinance' END AS known,
         'U' || user_id AS ticker, ts::DATE AS d, value::DECIMAL(18,2) AS price,
         ts < TIMESTAMP '2024-01-08' AS is_processed
  FROM events),
lake_quotes AS (
  SELECT ticker, d, known AS source, ts, record_id,
         CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS element_pos,
         CASE event_type WHEN 'click' THEN price ELSE 0 END AS ohl,
         price AS close,
         CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS volume
  FROM lake WHERE reason IS NULL)"""

LAKE_TEXT = """
lake_text AS (
  SELECT *, '{"ticker":"' || ticker || '","date":"' || d || '"' AS head,
         ',"open":' || price || ',"high":' || price || ',"low":' || price
           || ',"close":' || price || ',"volume":1}' AS tail
  FROM lake)"""

LAKE_QUOTE_COLUMNS = """
  ticker, strftime(d, '%Y-%m-%d') AS date, ohl::DOUBLE AS open, ohl::DOUBLE AS high,
  ohl::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume, source,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS loaded_at, record_id, element_pos"""

# Facts of the lake. A first load of the processed records precedes the rest, and the
# records are loaded in time order, so the first record of a key wins over all of them.
LAKE_FACTS = f"""{LAKE},
lake_facts AS (
  SELECT * FROM lake_quotes
  QUALIFY row_number() OVER (PARTITION BY ticker, d, source ORDER BY ts, record_id, element_pos) = 1)"""

_LAKE_TYPE = "CASE arg_min(source, (ts, record_id)) WHEN 'CoinGecko' THEN 'Crypto' ELSE 'Stock' END"


# Records before this moment are the first of two loads.
FIRST_LOAD = "TIMESTAMP '2024-01-08'"

LAKE_FACT_SELECT = """SELECT ticker, asset_type, source AS source_name,
       year(d) * 10000 + month(d) * 100 + day(d) AS date_key,
       ohl::DOUBLE AS open_price, ohl::DOUBLE AS high_price, ohl::DOUBLE AS low_price,
       close::DOUBLE AS close_price, volume::DOUBLE AS volume
FROM lake_facts JOIN types USING (ticker)"""


def lake_load(types: str) -> str:
    return f"WITH {LAKE_FACTS}, {types} {LAKE_FACT_SELECT}"


# Facts as they come out of the chart payloads: numbers equal to the close were sent as null.
CHART = f"""{FACTS},
chart AS (
  SELECT (asset_key * 10 + source_key) * 10000 + year(d) AS payload_id, 'P' || asset_key AS ticker, d,
         CASE WHEN low = close THEN 0 ELSE low END AS low,
         CASE WHEN high = close THEN 0 ELSE high END AS high,
         close, volume, year(d) + 1 || '-01-01 00:00:00' AS loaded_at
  FROM facts),
chart_rows AS (
  SELECT *, row_number() OVER (PARTITION BY payload_id ORDER BY d) - 1 AS element_pos FROM chart)"""
CHART_COLUMNS = """
  ticker, strftime(d, '%Y-%m-%d') AS date, low::DOUBLE AS open, high::DOUBLE AS high,
  low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume,
  'YahooFinance' AS source, loaded_at, payload_id AS record_id, element_pos"""

# Events as they come out of the pair payloads: for a fourth of the users the newest day of a
# month has no volume.
PAIRS = """
days AS (
  SELECT user_id, ts::DATE AS d, max(value)::DECIMAL(18,2) AS price, count(*) AS n
  FROM events GROUP BY ALL),
pairs AS (
  SELECT user_id * 1000000 + year(d) * 100 + month(d) AS payload_id, 'U' || user_id AS ticker, d, price,
         CASE WHEN user_id % 4 = 0 AND lead(d) OVER months IS NULL THEN 0 ELSE n END AS volume,
         row_number() OVER months - 1 AS element_pos,
         strftime(date_trunc('month', d) + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS loaded_at
  FROM days WINDOW months AS (PARTITION BY user_id, year(d), month(d) ORDER BY d))"""
PAIR_COLUMNS = """
  ticker, strftime(d, '%Y-%m-%d') AS date, price::DOUBLE AS open, price::DOUBLE AS high,
  price::DOUBLE AS low, price::DOUBLE AS close, volume::DOUBLE AS volume,
  'CoinGecko' AS source, loaded_at, payload_id AS record_id, element_pos"""


def shortest(value: str, places: int) -> str:
    """A decimal without trailing zeros."""
    return f"rtrim(rtrim(({value})::DECIMAL(24,{places})::VARCHAR, '0'), '.')"


BOTH_PAYLOADS = f"""WITH {CHART}, {PAIRS}
SELECT {CHART_COLUMNS} FROM chart_rows UNION ALL SELECT {PAIR_COLUMNS} FROM pairs"""

# New keys: numbered inside 4096 hash buckets, the buckets one after another.
NUMBERED = "row_number() OVER (ORDER BY substr(md5({0}), 1, 3), {0})"

def _violations(table: str, column: str, rule: str, test: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE {test}) AS n_rows FROM {source}"
    )


def _domain() -> str:
    checks = []
    wide = (
        "(SELECT *, source AS endpoint, 'x' AS raw_content, ts AS loaded_at FROM lake)"
    )
    for column in ("source", "endpoint", "raw_content", "loaded_at", "is_processed"):
        checks.append(_violations("lake", column, "required", f"{column} IS NULL", wide))
    for column, limit in (("source", 50), ("endpoint", 256)):
        checks.append(_violations("lake", column, "length", f"length({column}) > {limit}", wide))
    checks.append(
        _violations("lake", "source", "allowed", "lower(source) NOT IN ('yahoofinance', 'coingecko')", wide)
    )
    dim = "(SELECT *, NULL::VARCHAR AS exchange, 1 AS created_at, 1 AS updated_at FROM assets)"
    for column in ("ticker", "name", "asset_type", "is_active", "created_at", "updated_at"):
        checks.append(_violations("dim_assets", column, "required", f"{column} IS NULL", dim))
    for column, limit in (("ticker", 20), ("name", 200), ("asset_type", 20), ("exchange", 50)):
        checks.append(_violations("dim_assets", column, "length", f"length({column}) > {limit}", dim))
    checks.append(
        _violations("dim_assets", "asset_type", "allowed", "lower(asset_type) NOT IN ('stock', 'etf', 'crypto')", dim)
    )
    named = (
        "(SELECT source AS source_name, '' AS base_url, true AS is_active FROM lake_quotes GROUP BY source "
        "UNION ALL SELECT unnest(['A', 'N', 'R']), '', true)"
    )
    for column in ("source_name", "base_url", "is_active"):
        checks.append(_violations("dim_sources", column, "required", f"{column} IS NULL", named))
    for column, limit in (("source_name", 50), ("base_url", 256)):
        checks.append(_violations("dim_sources", column, "length", f"length({column}) > {limit}", named))
    return f"WITH {LAKE}, {ASSETS} " + " UNION ALL ".join(checks)


ASOF = f"""WITH {FACTS},
asked AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS asset_key, l_shipdate::DATE - l_linenumber AS day, l_quantity AS quantity
  FROM lineitem),
quoted AS (SELECT asset_key, d, arg_min(date_key, source_key) AS date_key, arg_min(close, source_key) AS close FROM facts GROUP BY ALL)
SELECT a.l_orderkey, a.l_linenumber, a.asset_key, strftime(a.day, '%Y-%m-%d') AS day, a.quantity,
       q.date_key AS quote_date_key, q.close::DOUBLE AS quote
FROM asked a ASOF LEFT JOIN quoted q ON a.asset_key = q.asset_key AND a.day >= q.d"""

# The states of the assets between the days on which the dimension changed, equal neighbours as one.
VERSIONS = """
days(step, day) AS (
  VALUES (0, DATE '0001-01-01'), (1, DATE '1994-06-15'), (2, DATE '1996-03-01'), (3, DATE '1997-01-01')),
states AS (
  SELECT p_partkey AS asset_key, step, day,
         CASE WHEN step >= 2 AND p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name,
         CASE WHEN step >= 1 AND p_partkey % 3 = 0 THEN p_type || ' II' ELSE p_type END AS asset_type,
         (p_size >= 6) <> (step >= 3 AND p_partkey % 6 = 0) AS is_active
  FROM part, days),
begun AS (
  SELECT * FROM states
  WINDOW w AS (PARTITION BY asset_key ORDER BY step)
  QUALIFY step = 0 OR name IS DISTINCT FROM lag(name) OVER w OR asset_type IS DISTINCT FROM lag(asset_type) OVER w
    OR is_active IS DISTINCT FROM lag(is_active) OVER w),
versions AS (
  SELECT asset_key, name, asset_type, is_active, day AS valid_from,
         lead(day) OVER (PARTITION BY asset_key ORDER BY step) AS valid_to FROM begun)"""

TICKS = """
ticks AS (
  SELECT 'U' || user_id AS ticker, user_id, ts, event_id AS seq, value::DECIMAL(18,2) AS price, event_type,
         date_trunc('hour', ts) AS starts FROM events)"""
BAR = """list(price ORDER BY ts, seq)[1]::DOUBLE AS open, max(price)::DOUBLE AS high, min(price)::DOUBLE AS low,
  list(price ORDER BY ts DESC, seq DESC)[1]::DOUBLE AS close, count(*)::DOUBLE AS volume, count(*) AS n_ticks"""


def stamp_text(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


ALERTS = f"""WITH {TICKS},
wanted AS (SELECT DISTINCT 'U' || user_id AS ticker, unnest(CASE WHEN user_id % 2 = 0 THEN [30, 100] ELSE [30] END) AS threshold FROM events),
sides AS (
  SELECT ticker, threshold, ts, seq, price, price >= threshold AS above,
         lag(price >= threshold) OVER w AS above_before, lag(ts) OVER w AS ts_before
  FROM ticks JOIN wanted USING (ticker) WINDOW w AS (PARTITION BY ticker, threshold ORDER BY ts, seq))
SELECT ticker, threshold::DOUBLE AS threshold, seq, price::DOUBLE AS price, CASE WHEN above THEN 'up' ELSE 'down' END AS direction
FROM sides WHERE above <> above_before AND ts - ts_before <= INTERVAL 3 DAY"""


def oracle_sql() -> dict[str, str]:
    """The check of every query, by the query's name."""
    report = f"""WITH {CHART}, {PAIRS},
counts AS (SELECT (SELECT count(DISTINCT payload_id) FROM chart) AS charts, (SELECT count(*) FROM chart) AS chart_quotes,
                  (SELECT count(DISTINCT payload_id) FROM pairs) AS pair_sets, (SELECT count(*) FROM pairs) AS pair_quotes,
                  (SELECT count(*) FROM (SELECT DISTINCT ticker, d FROM chart)) AS chart_facts)
SELECT 'extract' AS stage, 'YahooFinance' AS item, 'ok' AS status, charts AS rows, CAST(NULL AS VARCHAR) AS detail FROM counts
UNION ALL SELECT 'extract', 'CoinGecko', 'ok', pair_sets, NULL FROM counts
UNION ALL SELECT 'transform', 'records_processed', 'ok', charts + pair_sets, NULL FROM counts
UNION ALL SELECT 'transform', 'records_rejected', 'ok', 0, NULL
UNION ALL SELECT 'transform', 'quotes_parsed', 'ok', chart_quotes + pair_quotes, NULL FROM counts
UNION ALL SELECT 'load', 'facts_loaded', 'ok', chart_facts + pair_quotes, NULL FROM counts
UNION ALL SELECT 'load', 'quotes_skipped', 'ok', chart_quotes - chart_facts, NULL FROM counts
UNION ALL SELECT 'publish', 'fact_quotes', 'ok', chart_facts + pair_quotes, NULL FROM counts
UNION ALL SELECT 'run', 'pipeline', 'ok', 8, NULL"""

    two_load_types = f"""flagged AS (
  SELECT q.*, l.is_processed FROM lake_quotes q JOIN lake l USING (record_id)),
loads AS (
  SELECT ticker, is_processed, {_LAKE_TYPE} AS asset_type FROM flagged GROUP BY ALL),
types AS (
  SELECT ticker, arg_min(asset_type, is_processed) AS asset_type FROM loads GROUP BY ticker)"""

    pivot = ", ".join(
        f"max(normalized_return) FILTER (WHERE (SELECT max(l_shipdate)::DATE FROM lineitem) - d = {n}) AS day_{n}"
        for n in range(PIVOT_DAYS + 1)
    )
    fact_select = f"SELECT {FACT_COLUMNS} FROM"

    return {
        # Marts
        "portfolio_summary": f"WITH {SUMMARY} {SUMMARY_SELECT}",
        "portfolio_summary_rowprev": f"WITH {SUMMARY_BY_ROW} {SUMMARY_SELECT}",
        "daily_performance": f"WITH {SUMMARY} {DAILY_SELECT}",
        "daily_performance_rowprev": f"WITH {SUMMARY_BY_ROW} {DAILY_SELECT}",
        "asset_history_view": f"WITH {HISTORY} SELECT {HISTORY_COLUMNS} FROM history",
        "asset_history": f"WITH {HISTORY} SELECT {HISTORY_COLUMNS} FROM history WHERE nth <= 30",
        "comparative_returns": f"WITH {compared(90)} {COMPARED_SELECT}",
        "comparative_returns_year": f"WITH {compared(365)} {COMPARED_SELECT}",
        "week52_high_low": f"""WITH {WEEK52}
SELECT ticker, name, asset_type, last_close::DOUBLE AS last_close, high_52w::DOUBLE AS high_52w,
       low_52w::DOUBLE AS low_52w, pct_from_high, pct_from_low FROM screener""",
        "latest_close": f"""WITH {FACTS}
SELECT asset_key, close::DOUBLE AS last_close, date_key FROM facts
QUALIFY row_number() OVER (PARTITION BY asset_key ORDER BY d DESC, source_key) = 1""",
        # Pages
        "asset_sma": f"""WITH {HISTORY},
cut AS (
  SELECT *, {cents('close')} AS c, ticker AS t FROM history WHERE nth <= 365)
SELECT ticker, strftime(d, '%Y-%m-%d') AS date, source_key, close::DOUBLE AS close,
       CASE WHEN count(*) OVER w = 20 THEN ((sum(c) OVER w * 2 + 20) // 40)::DOUBLE / 100 END AS sma
FROM cut WINDOW w AS (PARTITION BY ticker ORDER BY nth DESC ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
        "asset_header": f"""WITH {SUMMARY}
SELECT a.ticker, coalesce(s.name, a.ticker) AS name, coalesce(s.asset_type, '') AS asset_type,
       coalesce(s.last_close, 0)::DOUBLE AS last_close,
       coalesce({change('s.last_close', 's.previous_close')}, 0) AS change_percent
FROM assets a LEFT JOIN summary s USING (ticker)""",
        "compare_grid": f"""WITH {compared(90)}
SELECT t.ticker, strftime(x.d, '%Y-%m-%d') AS date, y.normalized_return
FROM (SELECT DISTINCT ticker FROM daily) t CROSS JOIN (SELECT DISTINCT d FROM daily) x
LEFT JOIN daily y ON y.ticker = t.ticker AND y.d = x.d""",
        "compare_pivot": f"WITH {compared(PIVOT_DAYS)} SELECT ticker, {pivot} FROM daily GROUP BY ticker",
        "compare_series": f"""WITH {compared(90)}
SELECT ticker, string_agg(strftime(d, '%Y-%m-%d') || '=' || normalized_return::DECIMAL(20,2), ';' ORDER BY d) AS series
FROM daily GROUP BY ticker""",
        "compare_tickers": f"WITH {compared(90)} SELECT DISTINCT ticker FROM compared",
        "compare_dates": f"WITH {compared(90)} SELECT DISTINCT strftime(d, '%Y-%m-%d') AS date FROM compared",
        "week52_position": f"""WITH {PLACED}
SELECT ticker, name, asset_type, last_close::DOUBLE AS last_close, high_52w::DOUBLE AS high_52w,
       low_52w::DOUBLE AS low_52w, pct_from_high, pct_from_low, position, {BAND} AS band,
       CASE WHEN pct_from_high >= 0 THEN 'up' ELSE 'down' END AS high_direction,
       CASE WHEN pct_from_low >= 0 THEN 'up' ELSE 'down' END AS low_direction FROM placed""",
        "week52_display": f"""WITH {PLACED}
SELECT ticker, name, asset_type, {grouped('last_close')} AS last_close, {grouped('high_52w')} AS high_52w,
       {grouped('low_52w')} AS low_52w, {signed('pct_from_high')} AS pct_from_high,
       '+' || {grouped('pct_from_low')} || '%' AS pct_from_low, position || '%' AS position, {BAND} AS band
FROM placed""",
        "portfolio_display": f"""WITH {SUMMARY},
changed AS (SELECT *, {change('last_close', 'previous_close')} AS pct FROM summary)
SELECT ticker, name, asset_type, {grouped('last_close')} AS last_close,
       {grouped('coalesce(previous_close, 0)')} AS previous_close, {signed('pct')} AS change_percent,
       CASE WHEN pct >= 0 THEN 'up' ELSE 'down' END AS direction FROM changed""",
        "history_display": f"""WITH {HISTORY}
SELECT ticker, source_key, strftime(d, '%Y-%m-%d') AS date,
       {grouped('round(low, 2)')} AS open, {grouped('round(high, 2)')} AS high,
       {grouped('round(low, 2)')} AS low, {grouped('close')} AS close, {grouped('volume', 0)} AS volume
FROM history WHERE nth <= 30""",
        # Dimensions
        "active_assets": f"""WITH {ASSETS}
SELECT asset_key, ticker, name, asset_type, NULL::VARCHAR AS exchange, is_active,
       '1995-01-01 00:00:00' AS created_at, '1995-01-01 00:00:00' AS updated_at
FROM assets WHERE is_active ORDER BY ticker""",
        "dim_lookup": f"""WITH {ASSETS},
wanted AS (SELECT DISTINCT 'P' || o_orderkey AS ticker FROM orders)
SELECT ticker, asset_key, name, asset_type, NULL::VARCHAR AS exchange, is_active::VARCHAR AS is_active,
       CASE WHEN asset_key IS NOT NULL THEN '1995-01-01 00:00:00' END AS created_at,
       CASE WHEN asset_key IS NOT NULL THEN '1995-01-01 00:00:00' END AS updated_at
FROM wanted LEFT JOIN assets USING (ticker)""",
        "dim_dates": f"""
SELECT {CALENDAR} FROM (
  SELECT l_shipdate::DATE AS d FROM lineitem UNION SELECT ts::DATE FROM events)""",
        "dim_dates_missing": f"""
SELECT {CALENDAR} FROM (
  SELECT o_orderdate::DATE AS d FROM orders EXCEPT SELECT l_shipdate::DATE FROM lineitem)""",
        "dim_assets_upsert": f"""WITH {LAKE}, {ASSETS},
line_tickers AS (SELECT DISTINCT 'P' || l_partkey AS ticker FROM lineitem),
fresh AS (SELECT ticker, {_LAKE_TYPE} AS asset_type FROM lake_quotes GROUP BY ticker)
SELECT asset_key, ticker, coalesce(t.ticker, name) AS name,
       CASE WHEN t.ticker IS NULL THEN asset_type ELSE 'Stock' END AS asset_type,
       NULL::VARCHAR AS exchange, t.ticker IS NOT NULL OR is_active AS is_active,
       '1995-01-01 00:00:00' AS created_at,
       CASE WHEN t.ticker IS NULL THEN '1995-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at
FROM assets LEFT JOIN line_tickers t USING (ticker)
UNION ALL
SELECT (SELECT max(asset_key) FROM assets) + {NUMBERED.format('ticker')}, ticker, ticker, asset_type,
       NULL, true, '2024-02-01 00:00:00', '2024-02-01 00:00:00' FROM fresh""",
        "dim_sources_upsert": f"""WITH {LAKE},
stored AS (SELECT * FROM (VALUES (1, 'A'), (2, 'N'), (3, 'R')) s(source_key, source_name)),
fresh AS (SELECT DISTINCT source AS source_name FROM lake_quotes)
SELECT source_key, source_name, '' AS base_url, true AS is_active FROM stored
UNION ALL
SELECT 3 + {NUMBERED.format('source_name')}, source_name, '', true FROM fresh""",
        # Facts
        "fact_build": f"WITH {QUOTES}, all_rows AS (SELECT *, {ID} AS id FROM quotes) {fact_select} all_rows",
        "fact_dedup_first": f"WITH {FACTS} {fact_select} facts",
        "fact_dedup_last": f"""WITH {QUOTES}, newest AS (
  SELECT *, {ID} AS id FROM quotes
  QUALIFY row_number() OVER (PARTITION BY asset_key, d, source_key ORDER BY {BATCH_ORDER_DOWN}) = 1)
{fact_select} newest""",
        "fact_new_only": f"WITH {QUOTES}, {OVERLAPPING} {fact_select} incoming WHERE n_stored = 0",
        "fact_existing": f"WITH {QUOTES}, {OVERLAPPING} {fact_select} incoming WHERE n_stored > 0",
        "fact_load": f"""WITH {QUOTES}, second_batch AS (
  SELECT * EXCLUDE (loaded_at), {ID} AS id, TIMESTAMP '2024-02-01' AS loaded_at FROM quotes q
  WHERE status <> 'F' AND NOT EXISTS (
    SELECT 1 FROM quotes s WHERE s.status = 'F' AND s.asset_key = q.asset_key AND s.d = q.d
      AND s.source_key = q.source_key)
  QUALIFY row_number() OVER (PARTITION BY asset_key, d, source_key ORDER BY q.{BATCH_ORDER}) = 1)
{fact_select} second_batch""",
        "fact_replace": f"""WITH {QUOTES}, newest AS (
  SELECT *, {ID} AS id FROM quotes
  QUALIFY row_number() OVER (PARTITION BY asset_key, d, source_key
    ORDER BY loaded_at DESC, CASE status WHEN 'F' THEN 1 ELSE 0 END, {BATCH_ORDER_DOWN}) = 1)
{fact_select} newest""",
        "fact_delta_scan": f"""WITH {FACTS}
{fact_select} facts WHERE id > (DATE '1999-01-01' - DATE '0001-01-01') * 1024""",
        "publish_snapshot": f"""WITH {LAKE_FACTS}
SELECT ticker, source AS source_name, 1 AS is_active, '' AS exchange,
       year(d) * 10000 + month(d) * 100 + day(d) AS date_key, (isodow(d) >= 6)::INTEGER AS is_weekend,
       close::DOUBLE AS close_price, volume::DOUBLE AS volume FROM lake_facts""",
        "publish_dimension": f"""WITH {ASSETS}
SELECT asset_key, ticker, name, asset_type, '' AS exchange, is_active::INTEGER AS is_active,
       '1995-01-01 00:00:00' AS created_at, '1995-01-01 00:00:00' AS updated_at FROM assets""",
        # Data quality
        "dq_unique": f"""WITH {QUOTES}
SELECT asset_key, date_key, source_key, count(*) AS n_rows FROM quotes GROUP BY ALL HAVING count(*) > 1""",
        "dq_orphans": f"""WITH {FACTS}, {ASSETS}
{fact_select} facts WHERE asset_key NOT IN (SELECT asset_key FROM assets WHERE is_active)""",
        "dq_domain": _domain(),
        # Lake
        "lake_unprocessed": f"""WITH {LAKE}, {LAKE_TEXT}
SELECT record_id, source, source AS endpoint,
       CASE event_type
         WHEN 'click' THEN '[{{"ticker":" ","date":"2024-01-01"}},' || head || tail || ']'
         WHEN 'signup' THEN head || ',"close":' || price || '}}'
         WHEN 'purchase' THEN '[' || head || tail || ',' || head || ',"close":null}}]'
         WHEN 'error' THEN '[' || head || tail
         ELSE '[' || head || tail || ']' END AS raw_content,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS loaded_at, is_processed
FROM lake_text WHERE NOT is_processed ORDER BY ts, record_id""",
        "lake_parse": f"WITH {LAKE} SELECT {LAKE_QUOTE_COLUMNS} FROM lake_quotes",
        "lake_rejects": f"""WITH {LAKE}
SELECT record_id, known AS source, -1 AS element_pos, reason FROM lake WHERE reason IS NOT NULL""",
        "lake_mark_processed": f"""WITH {LAKE}, {LAKE_TEXT}
SELECT record_id, source, source AS endpoint,
       CASE event_type
         WHEN 'click' THEN '[{{"ticker":" ","date":"2024-01-01"}},' || head || tail || ']'
         WHEN 'signup' THEN head || ',"close":' || price || '}}'
         WHEN 'purchase' THEN '[' || head || tail || ',' || head || ',"close":null}}]'
         WHEN 'error' THEN '[' || head || tail
         ELSE '[' || head || tail || ']' END AS raw_content,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS loaded_at, is_processed OR reason IS NULL AS is_processed
FROM lake_text""",
        "load_metrics": f"""WITH {LAKE}
SELECT count(*) AS records, count(*) FILTER (WHERE reason IS NULL) AS records_processed,
       count(reason) AS records_rejected, (SELECT count(*) FROM lake_quotes) AS quotes_parsed,
       count(*) FILTER (WHERE event_type = 'click') AS elements_skipped, 0 AS elements_rejected
FROM lake""",
        "load_metrics_by_source": f"""WITH {LAKE}
SELECT known AS source, coalesce(reason, 'processed') AS outcome, count(*) AS records,
       count(*) FILTER (WHERE reason IS NULL) AS quotes FROM lake GROUP BY ALL""",
        # Provider payloads
        "normalize_chart": f"WITH {CHART} SELECT {CHART_COLUMNS} FROM chart_rows",
        "normalize_pairs": f"WITH {PAIRS} SELECT {PAIR_COLUMNS} FROM pairs",
        "normalize_union": BOTH_PAYLOADS,
        "quotes_to_json": f"""WITH {CHART}
SELECT payload_id, '[' || string_agg(
  '{{"close":' || {shortest('close', 8)} || ',"date":"' || d || '","high":' || {shortest('high', 8)}
  || ',"low":' || {shortest('low', 8)} || ',"open":' || {shortest('low', 8)}
  || ',"ticker":"' || ticker || '","volume":' || {shortest('volume', 8)} || '}}', ',' ORDER BY d) || ']' AS raw_content
FROM chart GROUP BY payload_id""",
        "lake_wrap": f"""WITH {PAIRS}
SELECT payload_id AS record_id, 'CoinGecko' AS source, 'CoinGecko' AS endpoint, '[' || string_agg(
  '{{"close":' || {shortest('price', 8)} || ',"date":"' || d || '","high":' || {shortest('price', 8)}
  || ',"low":' || {shortest('price', 8)} || ',"open":' || {shortest('price', 8)}
  || ',"ticker":"' || ticker || '","volume":' || volume || '}}', ',' ORDER BY d) || ']' AS raw_content,
  any_value(loaded_at) AS loaded_at, false AS is_processed
FROM pairs GROUP BY payload_id""",
        "lake_round_trip": BOTH_PAYLOADS,
        "watchlist_filter": f"""WITH {QUOTES}, listed AS (
  SELECT 'P' || p_partkey AS ticker,
         CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'A' WHEN p_type = 'STANDARD' THEN 'N' ELSE 'R' END AS source
  FROM part)
SELECT q.ticker, strftime(d, '%Y-%m-%d') AS date, low::DOUBLE AS open, high::DOUBLE AS high,
       low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume, q.source,
       strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at, record_id, element_pos
FROM quotes q JOIN listed l ON l.ticker = q.ticker AND l.source = q.source WHERE q.source <> 'R'""",
        # Pipeline
        "lake_load": lake_load(two_load_types),
        "load_compacted": lake_load(two_load_types),
        "load_after_failure": f"""WITH {LAKE}, types AS (
  SELECT ticker, {_LAKE_TYPE} AS asset_type FROM lake_quotes WHERE ts < {FIRST_LOAD} GROUP BY ticker),
lake_facts AS (
  SELECT * FROM lake_quotes WHERE ts < {FIRST_LOAD}
  QUALIFY row_number() OVER (PARTITION BY ticker, d, source ORDER BY ts, record_id, element_pos) = 1)
{LAKE_FACT_SELECT}""",
        "fact_load_delta": f"""WITH {LAKE_FACTS}
{LAKE_FACT_SELECT.replace("asset_type, ", "").replace("JOIN types USING (ticker)", "")} WHERE ts >= {FIRST_LOAD}""",
        "lake_reingest": f"""WITH {PAIRS}
SELECT ticker, 'Crypto' AS asset_type, 'CoinGecko' AS source_name, year(d) * 10000 + month(d) * 100 + day(d) AS date_key,
       price::DOUBLE AS open_price, price::DOUBLE AS high_price, price::DOUBLE AS low_price, price::DOUBLE AS close_price,
       (CASE WHEN element_pos = 0 THEN 0 ELSE volume END)::DOUBLE AS volume FROM pairs""",
        "extract_rejects": f"""WITH {CHART}, {PAIRS}, ids AS (
  SELECT DISTINCT 'YahooFinance' AS source, payload_id FROM chart
  UNION ALL SELECT DISTINCT 'CoinGecko', payload_id FROM pairs)
SELECT source, source || '/' || payload_id AS endpoint, 'bad_payload' AS reason FROM ids WHERE payload_id % 7 = 0""",
        "publish_added": f"""WITH {LAKE_FACTS}
SELECT CASE WHEN ts < {FIRST_LOAD} THEN 1 ELSE 2 END AS version, count(*) AS n_facts FROM lake_facts GROUP BY 1""",
        "lake_faults": """
SELECT event_id AS record_id, 'YahooFinance' AS source, [1, 0, -1, -1, 0, 0, -1][event_id % 7 + 1]::INTEGER AS element_pos,
       ['out_of_range', 'too_long', 'bad_element', 'bad_element', '', '', 'bad_payload'][event_id % 7 + 1] AS reason
FROM events WHERE event_id % 7 NOT IN (4, 5)""",
        "lake_fault_metrics": """
SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 7 IN (0, 1, 4, 5)) AS records_processed,
       count(*) FILTER (WHERE event_id % 7 IN (2, 3, 6)) AS records_rejected,
       count(*) FILTER (WHERE event_id % 7 IN (0, 1, 4, 5)) AS quotes_parsed,
       count(*) FILTER (WHERE event_id % 7 IN (4, 5)) AS elements_skipped,
       count(*) FILTER (WHERE event_id % 7 IN (0, 1)) AS elements_rejected FROM events""",
        "asset_history_one": f"""WITH {HISTORY}
SELECT strftime(d, '%Y-%m-%d') AS date, low::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low,
       close::DOUBLE AS close, volume::DOUBLE AS volume
FROM history WHERE nth <= 365 AND ticker = (SELECT min(ticker) FROM assets WHERE is_active)""",
        "dq_constraints": f"""WITH {QUOTES}, {ASSETS}, repeated AS (
  SELECT 1 FROM quotes GROUP BY asset_key, date_key, source_key HAVING count(*) > 1)
SELECT 'unique' AS rule, 'dim_assets.ticker' AS subject, count(ticker) - count(DISTINCT ticker) AS n_broken FROM assets
UNION ALL SELECT 'unique', 'dim_dates.full_date', 0
UNION ALL SELECT 'unique', 'dim_sources.source_name', 0
UNION ALL SELECT 'unique', 'orders.full_date', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderdate::DATE HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'fact_quotes.key', count(*) FROM repeated
UNION ALL SELECT 'reference', 'fact_quotes.asset_key', count(*) FROM quotes WHERE asset_key NOT IN (SELECT asset_key FROM assets)
UNION ALL SELECT 'reference', 'fact_quotes.date_key', 0
UNION ALL SELECT 'reference', 'fact_quotes.source_key', count(*) FROM quotes WHERE source_key <= 1""",
        "etl_run_report": report,
        "stream_load": lake_load(two_load_types),
        # Kept state
        "kept_marts": f"""WITH {FACTS}, {ASSETS},
parted AS (
  SELECT *, CASE WHEN d >= DATE '1998-01-01' OR d >= DATE '1997-01-01' AND source = 'R' THEN 3
                 WHEN d >= DATE '1997-01-01' THEN 2 ELSE 1 END AS part FROM facts),
steps(load, day) AS (VALUES (1, DATE '1996-12-31'), (2, DATE '1997-12-31'), (3, DATE '1998-12-01')),
seen AS (SELECT s.load, s.day, p.* FROM steps s JOIN parted p ON p.part <= s.load),
day_closes AS (SELECT load, asset_key, d, arg_min(close, source_key) AS close FROM seen GROUP BY ALL),
ordered AS (SELECT load, asset_key, list(close ORDER BY d DESC) AS closes FROM day_closes GROUP BY load, asset_key),
spans AS (
  SELECT load, asset_key, max(close) FILTER (WHERE d >= day - 365) AS high, min(close) FILTER (WHERE d >= day - 365) AS low
  FROM seen GROUP BY load, asset_key),
answers AS (
  SELECT load, ticker, name, asset_type, closes[1] AS last_close, closes[2] AS previous_close, high, low
  FROM ordered JOIN spans USING (load, asset_key) JOIN assets USING (asset_key) WHERE is_active)
SELECT load, ticker, name, asset_type, last_close::DOUBLE AS last_close,
       coalesce(previous_close, 0)::DOUBLE AS previous_close, {change('last_close', 'previous_close')} AS change_percent,
       ifnull(high, last_close)::DOUBLE AS high_52w, ifnull(low, last_close)::DOUBLE AS low_52w,
       {change('last_close', 'high')} AS pct_from_high, {change('last_close', 'low')} AS pct_from_low
FROM answers""",
        "load_rebased": lake_load(two_load_types),
        "close_sketches": f"""WITH {FACTS}
SELECT year(d) * 100 + month(d) AS month, count(*) AS n_quotes, count(*) AS n_sketched, true AS q25_near, true AS q50_near,
       true AS q75_near, true AS n_distinct_near FROM facts GROUP BY ALL""",
        "quote_cube": f"""WITH {FACTS}, {ASSETS}
SELECT a.asset_type, f.source_key, year(f.d) AS year, grouping_id(a.asset_type, f.source_key, year(f.d)) AS level,
       count(*) AS n_quotes, sum(f.volume)::DOUBLE AS volume, min(f.low)::DOUBLE AS low, max(f.high)::DOUBLE AS high
FROM facts f JOIN assets a USING (asset_key) GROUP BY CUBE (a.asset_type, f.source_key, year(f.d))""",
        "sma_whole_history": f"""WITH {FACTS},
held AS (SELECT asset_key, date_key, source_key, close, {cents('close')} AS c FROM facts)
SELECT asset_key, date_key, source_key, close::DOUBLE AS close_price,
       CASE WHEN count(*) OVER w = 20 THEN ((sum(c) OVER w * 2 + 20) // 40)::DOUBLE / 100 END AS sma
FROM held WINDOW w AS (PARTITION BY asset_key ORDER BY date_key, source_key DESC ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
        "fact_pages": f"WITH {FACTS} SELECT id, (row_number() OVER (ORDER BY id) - 1) // 10000 AS page FROM facts",
        # Joins in time
        "asof_quotes": ASOF,
        "asof_quotes_ranged": ASOF,
        "asset_versions": f"""WITH {VERSIONS}
SELECT asset_key, 'P' || asset_key AS ticker, name, asset_type, NULL::VARCHAR AS exchange, is_active,
       strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to FROM versions""",
        "facts_at_versions": f"""WITH {FACTS}, {VERSIONS}
SELECT f.asset_key, f.date_key, f.source_key, strftime(f.d, '%Y-%m-%d') AS day, f.close::DOUBLE AS close_price,
       'P' || f.asset_key AS ticker, v.name, v.asset_type, v.is_active,
       strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to
FROM facts f LEFT JOIN versions v ON v.asset_key = f.asset_key AND f.d >= valid_from AND (valid_to IS NULL OR f.d < valid_to)""",
        # Streams of ticks
        "stream_bars": f"""WITH {TICKS},
landed AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15 06:30:00' AND event_type <> 'error' THEN 1 ELSE 2 END AS step FROM ticks),
mark AS (SELECT max(ts) - INTERVAL 2 HOUR AS first FROM landed WHERE step = 1),
placed AS (
  SELECT *, step = 2 AND starts + INTERVAL 1 HOUR <= coalesce(first, TIMESTAMP '0001-01-01') AS late FROM landed, mark),
ends AS (SELECT max(ts) - INTERVAL 2 HOUR AS last FROM placed WHERE NOT late),
barred AS (SELECT ticker, starts, late, {BAR} FROM placed GROUP BY ALL)
SELECT ticker, {stamp_text('starts')} AS starts, {stamp_text('starts + INTERVAL 1 HOUR')} AS ends, open, high, low, close, volume, n_ticks,
       CASE WHEN late THEN 'late' WHEN starts + INTERVAL 1 HOUR <= greatest(first, last) THEN 'finished' ELSE 'open' END AS state
FROM barred, mark, ends""",
        "daily_bars": f"""WITH {TICKS},
barred AS (SELECT ticker, date_trunc('day', ts)::TIMESTAMP AS starts, {BAR} FROM ticks GROUP BY ALL)
SELECT ticker, {stamp_text('starts')} AS starts, {stamp_text('starts + INTERVAL 1 DAY')} AS ends, open, high, low, close, volume, n_ticks FROM barred""",
        "price_alerts": ALERTS,
        "stream_alerts": ALERTS,
    }
