"""Text forms of numbers and taxon names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faunatally.functions.nulls import if_known


SIGNIFICANT = 15


def number_text(column: Column) -> Column:
    """A double as plain decimal text: 15 significant digits at most, no exponent, no trailing zeros.

    ``1200.0`` is ``1200``, ``12345678.5`` itself, ``0.0001`` not ``1.0E-4`` and ``0.1 + 0.2`` is ``0.3``. Numbers from 1e15
    on are whole and written with all their digits. NULL, NaN and infinities are NULL.
    """
    x = column.cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    # decimals that leave 15 digits from the first one that is not zero
    decimals = F.lit(SIGNIFICANT - 1) - F.floor(F.log10(F.abs(x))).cast("int")
    places = F.least(F.greatest(decimals, F.lit(1)), F.lit(340))
    plain = F.regexp_replace(F.translate(F.call_function("format_number", x, places), ",", ""), r"\.?0+$", "")
    large = F.translate(F.format_number(x, 0), ",", "")
    text = F.when(x == 0, F.lit("0")).when(F.abs(x) >= 10.0**SIGNIFICANT, large).otherwise(plain)
    return F.when(finite, text)


def range_text(low: Column, high: Column) -> Column:
    """``low`` when both ends are equal, else ``low - high``; NULL when the ends are unknown."""
    return if_known(low == high, number_text(low), F.concat(number_text(low), F.lit(" - "), number_text(high)))


def first_word(column: Column) -> Column:
    """Text before the first space, NULL when there is none (blank text, leading space)."""
    return F.regexp_substr(column, F.lit("^[^ ]+"))


def marked_name(name: Column, family: Column) -> Column:
    """Markdown form of a taxon name.

    A name with a space is a species and becomes italic. A single word is a genus when the family is known, not blank
    and different from it: italic, followed by ``sp.``. Anything else stays plain. The rule looks at names only, never
    at the recorded rank.
    """
    species = name.contains(" ")
    genus = ~species & (family != "") & (name != family)
    return (
        F.when(species, F.concat(F.lit("*"), name, F.lit("*")))
        .when(genus, F.concat(F.lit("*"), name, F.lit("* sp.")))
        .otherwise(name)
    )
