"""Reading 256-bit integers out of hex payloads with column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_DIGITS = 64


def word(data: Column, index: int | Column) -> Column:
    """The ``index``-th 32-byte word (0-based) behind the ``0x`` prefix, or null when the payload ends before it."""
    start = F.lit(3) + F.lit(WORD_DIGITS) * (index if isinstance(index, Column) else F.lit(index))
    digits = F.substr(data, start.cast("int"), F.lit(WORD_DIGITS))
    return F.when(F.length(digits) == WORD_DIGITS, digits)


def hex_to_double(digits: Column) -> Column:
    """Unsigned hex digits as the nearest double; null when a character is no hex digit.

    A hexadecimal floating-point literal is parsed with a single correct rounding, so all 256 bits are
    covered without a wide integer type. Its grammar also knows a point, which digits must not contain.
    """
    literal = F.concat(F.lit("0x"), digits, F.lit("p0"))
    return F.when(~F.contains(digits, F.lit(".")), literal.try_cast("double"))


def word_amount(data: Column, index: int | Column, decimals: int | Column) -> Column:
    """The ``index``-th word as a token amount: integer value over ``10 ** decimals``."""
    unit = F.pow(F.lit(10.0), decimals) if isinstance(decimals, Column) else F.lit(10.0**decimals)
    return hex_to_double(word(data, index)) / unit
