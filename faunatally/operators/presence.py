"""Which units (deployments) a group occurs in, as exact sets that can be merged.

Units are numbered, and a set is kept as rows of 64 units each: ``unit_word``, the number divided by 64, and ``unit_bits``, one
bit per unit. Sets are merged with ``bit_or`` and counted with ``bit_count``, both folded in the map tasks and compiled. A set
is never more rows than its (group, unit) pairs and up to 64 times fewer, so the one form serves taxa seen once and taxa
seen everywhere; bitmaps of a fixed 4 KB would cost the rare ones 250 times their pairs. Units that are NULL are one
unknown unit, in word -1.

One table of sets per taxon, zone, side of a depth threshold and flag answers every frequency question, for coarser groups too,
as sets of parts merge to the set of the whole where distinct counts would not add up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.functions import DEPTH_ZONES, Band, band_label, band_position
from faunatally.operators.keyed_join import keyed_join
from faunatally.operators.numbering import number_sorted
from faunatally.schema import TAXON

WORD, BITS = "unit_word", "unit_bits"
UNKNOWN_WORD = -1
SIDE = "depth_side"
DEEP, SHALLOW = "deep", "shallow"

#: Measures kept beside the sets, and how they fold.
MEASURES = {
    "individualCount": ("max", "individualCount"),
    "min_depth": ("min", "depth_m"),
    "max_depth": ("max", "depth_m"),
}


def is_sets(df: DataFrame) -> bool:
    return {WORD, BITS} <= set(df.columns)


def unit_numbers(df: DataFrame, unit: str = "deployment") -> DataFrame:
    """(unit, unit_no): the known units numbered from 0 in order, without bringing them to one task."""
    known = df.where(F.col(unit).isNotNull()).select(unit).distinct()
    return number_sorted(known, [unit], "unit_no")


def presence_sets(
    df: DataFrame,
    numbers: DataFrame,
    *,
    unit: str = "deployment",
    by: Sequence[str] = TAXON,
    bands: Sequence[Band] = DEPTH_ZONES,
    threshold: float | None = None,
) -> DataFrame:
    """Sets of units per taxon, depth zone, side of the threshold, attraction and validity.

    The table stands for the sightings in ``occurrence``, ``zones`` and ``threshold``: it has their columns but
    the unit's, ``depth_m`` and ``taxonRank``. Depths are kept as the zone, the side and the range. Rows that come with
    their ``unit_no`` are not joined to ``numbers``.

    Rows are shuffled as they are, on the taxon and word, and zones, sides and bits are made where that brings them: two sightings
    of a taxon are seldom of one word and one task, so folding them before would only make the rows wider.
    """
    depth = F.col("depth_m")
    number = F.col("unit_no")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))
    numbered = df if "unit_no" in df.columns else keyed_join(df, numbers, [unit], "left")
    word = F.coalesce(F.shiftright(number, 6), F.lit(UNKNOWN_WORD))
    kept = [*by, "valid_for_freq", "attracted", "depth_m", "individualCount"]
    dealt = numbered.select(*kept, number.alias("unit_no"), word.alias(WORD)).repartition(*by, WORD)
    classed = dealt.select(
        *kept,
        band_label(depth, bands).alias("depth_zone"),
        F.when(depth > threshold, DEEP).when(depth <= threshold, SHALLOW).alias(SIDE)
        if threshold is not None
        else F.lit(None).cast("string").alias(SIDE),
        WORD,
        F.coalesce(bit, F.lit(1).cast("long")).alias(BITS),
    )
    folds = [_fold(how, column).alias(name) for name, (how, column) in MEASURES.items()]
    keys = [*by, "valid_for_freq", "attracted", "depth_zone", SIDE, WORD]
    sets = classed.groupBy(*keys).agg(F.bit_or(BITS).alias(BITS), *folds)
    return sets.withColumn("zone_pos", band_position(F.col("depth_zone"), bands))


def _fold(how: str, column: str | Column) -> Column:
    return {"min": F.min, "max": F.max, "any": F.bool_or}[how](column)


def fold_units(
    df: DataFrame,
    by: Sequence[str],
    unit: str,
    sides: Mapping[str, Column],
    measures: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Per group: for each side, the units with a row that meets its condition, and folded measures.

    ``<side>`` counts the known units; ``<side>_unknown`` says whether the unknown one is among them. Works on sightings,
    whose pairs of group and unit are made distinct first, and on sets.
    """
    measures = dict(measures or {})
    folded = [_fold(how, column).alias(name) for name, (how, column) in measures.items()]
    again = [_fold(how, name).alias(name) for name, (how, _) in measures.items()]
    if is_sets(df):
        none = F.lit(0).cast("long")
        merged = df.groupBy(*by, WORD).agg(
            *[F.bit_or(F.when(met, F.col(BITS)).otherwise(none)).alias(name) for name, met in sides.items()], *folded
        )
        known = F.col(WORD) != UNKNOWN_WORD
        n = {s: F.sum(F.when(known, F.bit_count(s)).otherwise(0)) for s in sides}
        unknown = {s: F.bool_or(~known & (F.col(s) != 0)) for s in sides}
    else:
        merged = df.groupBy(*by, unit).agg(
            *[F.bool_or(F.coalesce(met, F.lit(False))).alias(name) for name, met in sides.items()], *folded
        )
        known = F.col(unit).isNotNull()
        n = {s: F.count_if(F.col(s) & known) for s in sides}
        unknown = {s: F.bool_or(F.col(s) & ~known) for s in sides}
    return merged.groupBy(*by).agg(
        *[c.alias(s) for s, c in n.items()], *[c.alias(f"{s}_unknown") for s, c in unknown.items()], *again
    )


def number_of_units(side: str, count_null: bool) -> Column:
    """A side's count from ``fold_units``, with the unknown unit as one more or left out."""
    known = F.col(side).cast("long")
    return known + F.col(f"{side}_unknown").cast("long") if count_null else known
