"""Column expressions shared by the operators. All of them are native Spark expressions."""

from faunatally.functions.bands import DEPTH_ZONES, Band, band_label, band_position
from faunatally.functions.nulls import blank_if_null, if_known, listed_in, not_blank, not_listed_in
from faunatally.functions.numbers import half_even, percent
from faunatally.functions.text import first_word, marked_name, number_text, range_text

__all__ = [
    "DEPTH_ZONES",
    "Band",
    "band_label",
    "band_position",
    "blank_if_null",
    "first_word",
    "half_even",
    "if_known",
    "listed_in",
    "marked_name",
    "not_blank",
    "not_listed_in",
    "number_text",
    "percent",
    "range_text",
]
