"""Log positions: an unsigned 64-bit number, written as two hex halves ``hi/lo``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_HALF = 0xFFFFFFFF
INVALID = 0


def parse(text: Column) -> Column:
    """Position of ``'16/3002D50'``; text without a slash after its first character is invalid (0)."""
    hi = F.regexp_extract(text, "^(.+)/[^/]*$", 1)
    lo = F.regexp_extract(text, "^.+/([^/]*)$", 1)
    hex_ok = hi.rlike("^[0-9A-Fa-f]{1,15}$") & lo.rlike("^[0-9A-Fa-f]{1,15}$")
    value = F.shiftleft(_half(hi), 32).bitwiseOR(_half(lo))
    return (
        F.when(text.isNull(), F.lit(None).cast("long"))
        .when(hi == "", F.lit(INVALID).cast("long"))
        .when(hex_ok, value)
    )


def _half(digits: Column) -> Column:
    safe = F.when(digits.rlike("^[0-9A-Fa-f]{1,15}$"), digits).otherwise("0")
    return F.conv(safe, 16, 10).cast("long").bitwiseAND(F.lit(LOW_HALF))


def text(lsn: Column) -> Column:
    """``hi/lo`` in upper-case hex without leading zeros."""
    hi = F.hex(F.shiftrightunsigned(lsn, 32))
    return F.concat(hi, F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(LOW_HALF))))


def rank(lsn: Column) -> Column:
    """A signed number that sorts as the unsigned position does."""
    return lsn.bitwiseXOR(F.lit(-(1 << 63)))


def unrank(value: Column) -> Column:
    """The position behind a ``rank``."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def is_valid(lsn: Column) -> Column:
    return lsn != F.lit(INVALID)
