"""Number parsing that accepts exactly what a strict decimal parser accepts.

Spark's casts trim blanks and accept suffixes such as ``1.0d``, so every cast sits behind a pattern.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

_INTEGER = r"[+-]?[0-9]+"
_FINITE = (
    r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+"
)
_SPECIAL = r"[+-]?(?i:inf|infinity)|(?i:nan)"


def _is(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


def strict_int(text: Column, width: str = "int") -> Column:
    """Base-10 integer with optional sign; null when the text is anything else or out of range."""
    return F.when(_is(text, _INTEGER), text.try_cast(width))


def strict_long(text: Column) -> Column:
    return strict_int(text, "bigint")


def strict_double(text: Column) -> Column:
    """Decimal or hexadecimal float, infinity or NaN; null otherwise, also when a finite text overflows."""
    number = text.try_cast("double")
    overflow = F.abs(number) == F.lit(float("inf"))
    return (
        F.when(_is(text, _FINITE) & ~overflow, number)
        .when(_is(text, _SPECIAL), number)
    )


def read_double(text: str) -> float:
    """The same for one request parameter; ``ValueError`` where :func:`strict_double` is null."""
    if re.fullmatch(_SPECIAL, text):
        return float(text)
    if re.fullmatch(_FINITE, text):
        number = float.fromhex(text) if "x" in text.lower() else float(text)
        if not math.isinf(number):
            return number
    raise ValueError(f"not a number: {text!r}")


def int_or_default(text: Column, default: int) -> Column:
    return F.coalesce(strict_int(text), F.lit(default))
