"""Rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(column: Column, digits: int) -> Column:
    """Round half to even: 2.5 gives 2 at no digits, 6.25 gives 6.2 at one."""
    return F.bround(column, digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded share in percent, NULL for a zero denominator.

    The division comes before the multiplication: the other way round the last bit differs for many pairs, which
    moves values that lie on a rounding tie.
    """
    return half_even(F.try_divide(part, whole) * 100, digits)
