"""Named numeric bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Band(NamedTuple):
    """A labelled interval; an end left out is open to infinity."""

    label: str
    above: float | None = None
    at_least: float | None = None
    at_most: float | None = None
    below: float | None = None

    def holds(self, column: Column) -> Column:
        tests = []
        if self.above is not None:
            tests.append(column > self.above)
        if self.at_least is not None:
            tests.append(column >= self.at_least)
        if self.at_most is not None:
            tests.append(column <= self.at_most)
        if self.below is not None:
            tests.append(column < self.below)
        return reduce(and_, tests)


# The report's three depth zones, shallow to deep.
DEPTH_ZONES = (
    Band("<700 m", below=700),
    Band("700-1500 m", at_least=700, at_most=1500),
    Band(">1500 m", above=1500),
)


def band_label(column: Column, bands: Sequence[Band]) -> Column:
    """Label of the first band that holds the value; NULL for a NULL value or one in no band."""
    first, *rest = bands
    labels = F.when(first.holds(column), F.lit(first.label))
    for band in rest:
        labels = labels.when(band.holds(column), F.lit(band.label))
    return labels


def band_position(label: Column, bands: Sequence[Band]) -> Column:
    """1-based place of a band label in the given order, for sorting."""
    first, *rest = bands
    place = F.when(label == first.label, F.lit(1))
    for position, band in enumerate(rest, start=2):
        place = place.when(label == band.label, F.lit(position))
    return place
