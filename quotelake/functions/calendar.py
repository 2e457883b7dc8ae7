"""Date keys, calendar attributes and time-zone-free epoch conversion, as SQL expressions."""

from __future__ import annotations

import datetime as dt

SECONDS_PER_DAY = 86_400
MILLIS_PER_DAY = 86_400_000
# From 0001-01-01 to 1970-01-01.
DAYS_BEFORE_EPOCH = 719_162

UTC_NOW = "convert_timezone('UTC', localtimestamp())"


def date_key(day: str) -> str:
    """The YYYYMMDD integer of a date."""
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))"


def key_date(key: str) -> str:
    """The date of a YYYYMMDD integer."""
    return f"make_date(int({key} div 10000), int({key} div 100 % 100), int({key} % 100))"


def key_year(key: str) -> str:
    return f"int({key} div 10000)"


def day_number(key: str) -> str:
    """Days since 0001-01-01 of a YYYYMMDD integer; below 2**22 for every valid date."""
    return f"(unix_date({key_date(key)}) + {DAYS_BEFORE_EPOCH})"


def date_of_seconds(epoch: str) -> str:
    """The UTC date of epoch seconds."""
    return f"date_from_unix_date(int(floor({epoch} / {SECONDS_PER_DAY})))"


def date_of_millis(epoch: str) -> str:
    """The UTC date of epoch milliseconds."""
    return f"date_from_unix_date(int(floor({epoch} / {MILLIS_PER_DAY})))"


def iso_date(text: str) -> str:
    """The date of a ``yyyy-M-d`` text, null for anything else."""
    form = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
    return f"CASE WHEN {text} RLIKE '{form}' THEN try_cast({text} AS DATE) END"


def calendar_columns(day: str) -> list[str]:
    """The columns of the date dimension for one date. Weekdays count from 0 = Sunday."""
    return [
        f"{date_key(day)} AS date_key",
        f"{day} AS full_date",
        f"year({day}) AS year",
        f"quarter({day}) AS quarter",
        f"month({day}) AS month",
        f"day({day}) AS day",
        f"dayofweek({day}) - 1 AS day_of_week",
        f"weekofyear({day}) AS week_of_year",
        f"dayofweek({day}) IN (1, 7) AS is_weekend",
    ]


def look_back(as_of: dt.date | None, days: int) -> str:
    """First date of a window of ``days`` days ending at ``as_of``, or today; that day is
    inside. Either way it is a constant to the optimizer and reaches the file scan."""
    end = "current_date()" if as_of is None else f"DATE '{as_of:%Y-%m-%d}'"
    return f"date_sub({end}, {int(days)})"


def stamp(now: dt.datetime | None) -> str:
    """A given UTC time, or the present one."""
    return UTC_NOW if now is None else f"TIMESTAMP_NTZ '{now:%Y-%m-%d %H:%M:%S.%f}'"


def clamp(value: int, low: int, high: int) -> int:
    return max(low, min(high, value))
