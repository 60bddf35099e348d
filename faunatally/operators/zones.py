"""Characteristic fauna by depth zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faunatally.functions import DEPTH_ZONES, Band, band_label, band_position, if_known, not_blank, percent
from faunatally.operators.occurrence import count_units
from faunatally.operators.preparation import drop_columns
from faunatally.operators.presence import is_sets

# The two fauna groups.
FISH = "Fish"
INVERTEBRATE = "Invertebrate"


def _banded(df: DataFrame, bands: Sequence[Band]) -> DataFrame:
    if is_sets(df):  # sets are made with their zone
        return df.where(F.col("depth_zone").isNotNull())
    zoned = df.withColumn("depth_zone", band_label(F.col("depth_m"), bands)).where(F.col("depth_zone").isNotNull())
    return zoned.withColumn("zone_pos", band_position(F.col("depth_zone"), bands))


def zone_effort(meta: DataFrame, bands: Sequence[Band] = DEPTH_ZONES) -> DataFrame:
    """Deployments, and valid deployments, per depth zone."""
    return (
        _banded(meta, bands)
        .groupBy("depth_zone", "zone_pos")
        .agg(F.count(F.lit(1)).alias("total_zone_deps"), F.count_if("valid_for_freq").alias("valid_zone_deps"))
    )


def with_zone(
    df: DataFrame, zones: DataFrame, phylum: str, bands: Sequence[Band] = DEPTH_ZONES
) -> DataFrame:
    """Add depth zone, fauna group and the zone's effort; rows without a zone are dropped.

    ``zones`` comes from ``zone_effort`` and so has one row per band at most, which is why it may be broadcast. The
    fauna group of a row of unknown phylum is NULL.
    """
    fauna = if_known(F.col("phylum") == phylum, F.lit(FISH), F.lit(INVERTEBRATE))
    effort = zones.select("depth_zone", "total_zone_deps", "valid_zone_deps")
    return (
        _banded(df, bands).withColumn("fauna_group", fauna).join(F.broadcast(effort), "depth_zone", "left")
    )


def zone_frequency(
    zoned: DataFrame, group: str, n: int = 10, *, unit: str = "deployment", count_null: bool = False
) -> DataFrame:
    """The ``n`` most frequent groups of each zone and fauna group, as a share of the zone's own valid effort.

    The row number filter is a top-n that Spark applies within each task before the shuffle, so a zone with many
    groups sends only ``n`` rows per task to the task that ranks it.
    """
    keys = ["depth_zone", "zone_pos", "fauna_group", group, "valid_zone_deps"]
    rank = Window.partitionBy("depth_zone", "fauna_group").orderBy(
        F.desc_nulls_last("freq_occ"), F.asc_nulls_last(group)
    )
    return (
        count_units(
            zoned.where(not_blank(F.col(group)) & F.col("valid_for_freq")), keys, unit, "occ", count_null=count_null
        )
        .withColumn("freq_occ", percent(F.col("occ"), F.col("valid_zone_deps"), 1))
        .withColumn("rank_pos", F.row_number().over(rank))
        .where(F.col("rank_pos") <= n)
        .select("depth_zone", "zone_pos", "fauna_group", group, "occ", "freq_occ", "rank_pos")
        .orderBy("zone_pos", F.desc_nulls_last("freq_occ"), F.asc_nulls_last("fauna_group"), group)
    )


def zone_taxa(zoned: DataFrame, n: int = 10, **options) -> DataFrame:
    """Top names per zone and fauna group."""
    return zone_frequency(zoned, "scientificName", n, **options)


def zone_groups(zoned: DataFrame, n: int = 10, **options) -> DataFrame:
    """Top families of fish and top orders of invertebrates per zone."""
    group = if_known(F.col("fauna_group") == FISH, F.col("family"), F.col("tax_order"))
    return zone_frequency(zoned.withColumn("taxa_group", group), "taxa_group", n, **options)


def fauna_listing(frequencies: DataFrame, fauna: str) -> DataFrame:
    """One fauna group's rows of a zone table, without the group column."""
    return drop_columns(frequencies.where(F.col("fauna_group") == fauna), "fauna_group")
