"""Price arithmetic and display forms, as SQL expressions. Each rounding rule is the one
its caller shows."""

from __future__ import annotations

# Lower ends of the upper two bands of the range position.
HIGH_BAND = 70
MIDDLE_BAND = 30


def _guarded(base: str, value: str) -> str:
    return f"CASE WHEN {base} IS NULL OR {base} = 0 THEN 0 ELSE {value} END"


def percent_change(now: str, before: str) -> str:
    """Change in percent, half-up to 2 places; 0 when there is nothing to compare with."""
    return _guarded(before, f"round(({now} - {before}) / {before} * 100, 2)")


def normalized_return(price: str, base: str) -> str:
    """Price as percent of the base price, half-up to 2 places; 0 for a zero base."""
    return _guarded(base, f"round({price} / {base} * 100, 2)")


def range_position(last: str, low: str, high: str) -> str:
    """Where ``last`` lies between low (0) and high (100), half-to-even; 50 for no range."""
    span = f"({high} - {low})"
    return f"CASE WHEN {span} > 0 THEN int(bround(({last} - {low}) / {span} * 100)) ELSE 50 END"


def position_band(position: str) -> str:
    return (
        f"CASE WHEN {position} >= {HIGH_BAND} THEN 'high' "
        f"WHEN {position} >= {MIDDLE_BAND} THEN 'middle' ELSE 'low' END"
    )


def direction(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN 'up' ELSE 'down' END"


def grouped(value: str, places: int = 2) -> str:
    """Number with thousands separators, half away from zero."""
    return f"format_number(round({value}, {places}), {places})"


def signed_percent(value: str) -> str:
    return f"concat(CASE WHEN {value} >= 0 THEN '+' ELSE '' END, {grouped(value)}, '%')"
