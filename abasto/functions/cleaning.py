"""Text to typed columns.

``mode="strict"`` stops the job at a malformed value, ``mode="lenient"`` turns it into NULL.

Known oddities, kept on purpose: a whole number loses its decimal point (``12.0`` is 120), and a decimal comma is
dropped (``1.234,50`` is 1.23).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What survives in a number, the two date layouts, and the first two-digit year of the 1900s.
NOT_DECIMAL = r"[^0-9.\-]"
NOT_INTEGER = r"[^0-9\-]"
SIX_DIGITS = r"^[0-9]{6}\z"
ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
CENTURY_PIVOT = "70"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _check(mode: str) -> bool:
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode is strict or lenient, not {mode!r}")
    return mode == "lenient"


def trimmed(value: Column | str) -> Column:
    """Blanks off both ends; an all-blank text stays as the empty text."""
    return F.trim(_column(value))


def filled(value: Column | str) -> Column:
    """Blanks off both ends, NULL where nothing is left."""
    return F.nullif(F.trim(_column(value)), F.lit(""))


def is_blank(value: Column | str) -> Column:
    return F.coalesce(F.trim(_column(value)), F.lit("")) == ""


def has_key(value: Column | str) -> Column:
    """Row filter: the key is there and not blank. NULL compares to NULL and so drops out."""
    return F.trim(_column(value)) != ""


def _number(value: Column | str, junk: str, target: str, mode: str) -> Column:
    digits = F.nullif(F.regexp_replace(_column(value), junk, ""), F.lit(""))
    return digits.try_cast(target) if _check(mode) else digits.cast(target)


def decimal_number(value: Column | str, mode: str = "strict", target: str = "decimal(15,2)") -> Column:
    """Digits, dot and minus only, then a decimal rounded half away from zero."""
    return _number(value, NOT_DECIMAL, target, mode)


def whole_number(value: Column | str, mode: str = "strict", target: str = "int") -> Column:
    """Digits and minus only, then an integer."""
    return _number(value, NOT_INTEGER, target, mode)


def calendar_day(value: Column | str, mode: str = "strict") -> Column:
    """``yymmdd`` or ``yyyy-mm-dd``; any other text is NULL. Lenient mode trims first.

    The short layout is spelt out in the long one, so that one plain cast reads both. Lengths are compared before patterns.
    """
    lenient = _check(mode)
    value = F.trim(_column(value)) if lenient else _column(value)
    year, month, day = (F.substring(value, start, 2) for start in (1, 3, 5))
    century = F.when(year >= CENTURY_PIVOT, "19").otherwise("20")
    short, long = (F.length(value) == 6) & value.rlike(SIX_DIGITS), (F.length(value) == 10) & value.rlike(ISO_DAY)
    text = F.when(short, F.concat(century, year, F.lit("-"), month, F.lit("-"), day)).when(long, value)
    return text.try_cast("date") if lenient else text.cast("date")
