"""Where, how often and how many: measures per taxon or taxonomic group."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.functions import not_blank, not_listed_in, number_text, percent, range_text
from faunatally.operators.keyed_join import folded_join
from faunatally.operators.presence import fold_units, is_sets, number_of_units
from faunatally.schema import TAXON

ATTRACTED = "Attracted"  # fixed value


#: What a sighting is told by beside its deployment, and what the deployment adds.
SIGHTING = (*TAXON, "taxonRank", "attracted")
SIGHTING_FACTS = ("depth_m", "substrate_type", "valid_for_freq")


def compact_sightings(df: DataFrame, facts: DataFrame | None = None, *, hot: DataFrame | None = None) -> DataFrame:
    """The clean table with repeated sightings folded: one row per deployment, taxon and attraction, largest count kept.

    It keeps the clean table's column names, and every operator here, in ``effort``, ``taxonomy``, ``zones`` and
    ``threshold`` gives the same result on it as on the rows themselves. Only tentative identifications, which need
    the single rows, do not. A run of many queries reads the large table once to make this one.

    With ``facts``, ``df`` is the annotations before the merge with their deployments' facts: ``SIGHTING_FACTS`` and any others,
    which are kept. They are shuffled once, on the deployment, instead of once for the merge and once for the fold.
    ``hot`` is a result of ``hot_keys``.
    """
    folds = {"individualCount": F.max("individualCount")}
    if facts is None:
        keys = ["deployment", *SIGHTING_FACTS, *SIGHTING]
        return df.groupBy(*keys).agg(*[c.alias(name) for name, c in folds.items()])
    rows = df.select("deployment", *SIGHTING, *folds)
    found = folded_join(rows, facts.distinct(), "deployment", SIGHTING, folds, hot=hot)
    others = [c for c in facts.columns if c not in ("deployment", *SIGHTING_FACTS)]
    valid = F.coalesce("valid_for_freq", F.lit(True))
    return found.withColumn("valid_for_freq", valid).select("deployment", *SIGHTING_FACTS, *SIGHTING, *folds, *others)


def count_units(df: DataFrame, by: Sequence[str], unit: str, name: str, *, count_null: bool = False) -> DataFrame:
    """Distinct units per group. Pairs are made distinct first, so a large group is counted by many tasks.

    A NULL unit is left out, or counted as one unit of its own with ``count_null``.
    """
    counted = fold_units(df, by, unit, {name: F.lit(True)})
    return counted.select(*by, number_of_units(name, count_null).alias(name))


def distinct_values(df: DataFrame, column: str, name: str, *, count_null: bool = False) -> DataFrame:
    """One row: the number of distinct values, NULL left out or counted as one value."""
    counted = F.lit(1) if count_null else F.col(column)
    return df.select(column).distinct().agg(F.count(counted).alias(name))


def depth_ranges(df: DataFrame, by: Sequence[str] = TAXON) -> DataFrame:
    """Smallest and largest depth per taxon, and both as one text. A taxon of unknown depth gets NULLs."""
    low, high = ("min_depth", "max_depth") if is_sets(df) else ("depth_m", "depth_m")
    return (
        df.groupBy(*by)
        .agg(F.min(low).alias("min_depth"), F.max(high).alias("max_depth"))
        .withColumn("depth_range", range_text(F.col("min_depth"), F.col("max_depth")))
    )


def attracted_metrics(
    df: DataFrame,
    effort: DataFrame,
    by: Sequence[str] = TAXON,
    *,
    unit: str = "deployment",
    count_null: bool = False,
) -> DataFrame:
    """Frequency of occurrence (whole percent) and MaxN per taxon that came to the camera, both as text.

    The frequency counts valid deployments only, MaxN uses all. Rows are first folded per taxon and deployment.
    """
    rows = df.where(F.col("attracted") == ATTRACTED)
    found = fold_units(
        rows, by, unit, {"n_units": F.col("valid_for_freq")}, {"count": ("max", F.col("individualCount"))}
    )
    return found.select(
        *by,
        number_text(percent(number_of_units("n_units", count_null), effort.scalar(), 0)).alias("freq_occ"),
        F.col("count").cast("string").alias("max_n"),
    )


def taxon_measures(
    df: DataFrame,
    effort: DataFrame,
    by: Sequence[str] = TAXON,
    *,
    unit: str = "deployment",
    count_null: bool = False,
) -> DataFrame:
    """``depth_ranges`` and ``attracted_metrics`` of every taxon from one fold per taxon and deployment.

    A taxon that never came to the camera has NULL for the frequency and MaxN.
    """
    came = F.coalesce(F.col("attracted") == ATTRACTED, F.lit(False))
    low, high = ("min_depth", "max_depth") if is_sets(df) else ("depth_m", "depth_m")
    found = fold_units(
        df,
        by,
        unit,
        {"n_units": came & F.col("valid_for_freq")},
        {
            "came": ("any", came),
            "count": ("max", F.when(came, F.col("individualCount"))),
            "min_depth": ("min", F.col(low)),
            "max_depth": ("max", F.col(high)),
        },
    )
    share = number_text(percent(number_of_units("n_units", count_null), effort.scalar(), 0))
    return found.select(
        *by,
        "min_depth",
        "max_depth",
        range_text(F.col("min_depth"), F.col("max_depth")).alias("depth_range"),
        F.when(F.col("came"), share).alias("freq_occ"),
        F.col("count").cast("string").alias("max_n"),
    )


def frequency_of_occurrence(
    df: DataFrame,
    by: str,
    effort: DataFrame,
    *,
    where: Column | None = None,
    unit: str = "deployment",
    valid: str = "valid_for_freq",
    digits: int = 1,
    count_null: bool = False,
) -> DataFrame:
    """Share of the effort, in percent, in which each group occurs; most frequent first, equal ones by name."""
    rows = df.where(not_blank(F.col(by)) & F.col(valid))
    if where is not None:
        rows = rows.where(where)
    return (
        count_units(rows, [by], unit, "n_units", count_null=count_null)
        .select(by, percent(F.col("n_units"), effort.scalar(), digits).alias("freq_occ"))
        .orderBy(F.desc_nulls_last("freq_occ"), F.asc_nulls_last(by))
    )


def family_frequency(df: DataFrame, phylum: str, effort: DataFrame, **options) -> DataFrame:
    """Frequency of every family of the phylum."""
    return frequency_of_occurrence(df, "family", effort, where=F.col("phylum") == phylum, **options)


def order_frequency(df: DataFrame, phylum: str, effort: DataFrame, **options) -> DataFrame:
    """Frequency of every order outside the phylum. Rows of unknown phylum are left out."""
    return frequency_of_occurrence(df, "tax_order", effort, where=F.col("phylum") != phylum, **options)


def families_excluding(df: DataFrame, phylum: str, classes: Iterable[str]) -> DataFrame:
    """One row: families of the phylum outside the listed classes. A row of unknown class is outside them."""
    rows = df.where(
        (F.col("phylum") == phylum) & not_listed_in(F.col("class"), classes) & not_blank(F.col("family"))
    )
    return distinct_values(rows, "family", "n_families")


def distinct_phyla(df: DataFrame, *, count_null: bool = False) -> DataFrame:
    return distinct_values(df, "phylum", "n_phyla", count_null=count_null)


def family_count(df: DataFrame, phylum: str) -> DataFrame:
    """One row: named families of the phylum."""
    rows = df.where((F.col("phylum") == phylum) & not_blank(F.col("family")))
    return distinct_values(rows, "family", "n_families")


def group_count(df: DataFrame, outside_phylum: str, level: str = "tax_order") -> DataFrame:
    """One row: named groups of a level outside the phylum."""
    rows = df.where((F.col("phylum") != outside_phylum) & not_blank(F.col(level)))
    return distinct_values(rows, level, "n_groups")


def top_max_n(df: DataFrame, by: str = "scientificName", n: int = 10, *, where: Column | None = None) -> DataFrame:
    """The ``n`` groups with the largest single count, equal counts by name."""
    rows = df.where(F.col("individualCount").isNotNull())
    if where is not None:
        rows = rows.where(where)
    return (
        rows.groupBy(by)
        .agg(F.max("individualCount").alias("max_n"))
        .orderBy(F.desc("max_n"), F.asc_nulls_last(by))
        .limit(n)
    )
