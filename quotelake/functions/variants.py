"""Strict JSON reading on VARIANT, as SQL expressions: tells missing, null, text and number
apart."""

from __future__ import annotations

from collections.abc import Iterable

# Written behind the text; found again only if the text was one complete JSON value.
_END = "end of record"

# Fixed value: the largest magnitude a 96-bit decimal can hold.
MAX_DECIMAL = "79228162514264337593543950335D"


def parse_with_end(text: str) -> str:
    """``text`` parsed with the marker behind it; hand the result to ``only_value``.

    The parser stops at the end of the first value, so the text is wrapped in an array
    that closes with the marker, and the marker must come back as the second element.
    """
    return f"""try_parse_json(concat('[', {text}, ',"{_END}"]'))"""


def only_value(wrapped: str) -> str:
    """The only JSON value of a text; null when malformed or followed by anything else."""
    return (
        f"CASE WHEN size({items(wrapped)}) = 2 AND {read(wrapped, '$[1]', 'string')} = '{_END}' "
        f"THEN {member(wrapped, '$[0]')} END"
    )


def read(value: str, path: str, kind: str) -> str:
    """The value at ``path`` as a type; null when missing, null or not of that type."""
    return f"try_variant_get({value}, '{path}', '{kind}')"


def items(value: str, path: str = "$") -> str:
    """The elements of the array at ``path``; null when there is no array."""
    return read(value, path, "array<variant>")


def member(value: str, path: str) -> str:
    """The value at ``path``; null only when it is missing."""
    return read(value, path, "variant")


def members(value: str, names: Iterable[str], many: bool = False) -> str:
    """The values under several keys of an object, or of each object in an array, read in
    one pass; a missing key is null, and so is an element that is no object."""
    shape = f"struct<{','.join(f'{name}:variant' for name in names)}>"
    return read(value, "$", f"array<{shape}>" if many else shape)


def type_of(value: str, path: str = "") -> str:
    """The type name of a value; VOID for a JSON null, null when missing."""
    return f"schema_of_variant({member(value, path) if path else value})"


def is_text(value: str) -> str:
    """True for a text or a JSON null; null when missing."""
    return f"{type_of(value)} IN ('STRING', 'VOID')"


def is_number_type(type_name: str) -> str:
    return f"({type_name} IN ('BIGINT', 'DOUBLE') OR startswith({type_name}, 'DECIMAL'))"


def in_decimal_range(value: str) -> str:
    """True when a number fits a 96-bit decimal."""
    return f"coalesce(abs({read(value, '$', 'double')}) <= {MAX_DECIMAL}, false)"


def is_number_list(type_name: str) -> str:
    """True for the type name of an array of numbers and nulls."""
    return f"{type_name} RLIKE '^ARRAY<(VOID|BIGINT|DECIMAL[(][0-9]+,[0-9]+[)]|DOUBLE)>$'"
