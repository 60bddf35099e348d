"""Predicates with a stated answer for NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed_in(column: Column, values: Iterable) -> Column:
    """TRUE when the value is in the list; a NULL value is not, and gives FALSE."""
    return F.coalesce(column.isin(list(values)), F.lit(False))


def not_listed_in(column: Column, values: Iterable) -> Column:
    """TRUE when the value is outside the list. SQL's NOT IN would drop the NULL rows; this keeps them."""
    return ~listed_in(column, values)


def not_blank(column: Column) -> Column:
    """Filter for a value that is neither NULL nor the empty string."""
    return column != ""


def blank_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def if_known(condition: Column, yes: Column, no: Column) -> Column:
    """Two-way choice that stays NULL when the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)
