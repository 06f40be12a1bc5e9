"""Small column expressions shared by the plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.col(day) if isinstance(day, str) else day, "MM")


def exact_mean(value: str) -> Column:
    """Mean of a decimal column to 15 places, from an exact sum: the same whatever the order of the rows."""
    return F.try_divide(F.sum(value), F.count(value))


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """Share in percent, NULL when the whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), places)


def differs(left: Column, right: Column) -> Column:
    """True where the two values are not the same, NULL being a value of its own."""
    return ~left.eqNullSafe(right)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body, or a lambda in it, uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
