"""The taxon inventory: measures joined per taxon, ordered by key lists, names marked up for print."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.functions import blank_if_null, marked_name, not_listed_in
from faunatally.operators.keyed_join import fits_broadcast, keyed_join, null_safe_join
from faunatally.operators.numbering import number_sorted
from faunatally.schema import RANKS, TAXON

# Places of names that the key list of their level does not have, and of missing names: after all listed ones.
UNLISTED = 2_147_483_646
MISSING = 2_147_483_647

POSITIONS = {"phylum": "phylum_pos", "class": "class_pos", "tax_order": "order_pos", "family": "family_pos"}

# Headings of the printed table.
INVENTORY_LABELS = {
    "phylum": "Phylum",
    "class": "Class",
    "tax_order": "Order",
    "family": "Family",
    "scientificName": "Lowest Taxonomic ID",
    "depth_range": "Depth (m)",
    "freq_occ": "Freq. of Occ. (%)",
    "max_n": "MaxN",
}


def tentative_listing(df: DataFrame, by: Sequence[str] = TAXON) -> DataFrame:
    """The tentative identifications in long form: taxon, ``marked`` (marked up), ``first_seen`` and ``place`` from 0.

    First seen means smallest ``row_key``; equal keys go by value. Repeats are folded in the map tasks and the rest is ranked
    over range partitions, so a taxon with most of the identifications is spread over many tasks.
    """
    seen = _first_seen(df, by)
    return number_sorted(seen, ["first_seen", "marked"], "place", per=list(by))


def _first_seen(df: DataFrame, by: Sequence[str]) -> DataFrame:
    rows = df.where(F.col("tentativeId").isNotNull())
    marked = marked_name(F.col("tentativeId"), F.col("family")).alias("marked")
    # the markup may need a column of ``by`` and more, so it is made before the rows are folded
    return rows.select(*by, marked, "row_key").groupBy(*by, "marked").agg(F.min("row_key").alias("first_seen"))


def tentative_pieces(listing: DataFrame, by: Sequence[str] = TAXON, size: int = 1000) -> DataFrame:
    """(taxon, piece, text): the listing joined by ``", "`` in pieces of at most ``size`` identifications each."""
    piece = F.floor(F.col("place") / size).alias("piece")
    in_order = F.array_sort(F.collect_list(F.struct("place", "marked")))
    pieces = listing.select(*by, piece, "place", "marked").groupBy(*by, "piece").agg(in_order.alias("list"))
    return pieces.select(*by, "piece", F.concat_ws(", ", F.col("list.marked")).alias("text"))


def tentative_ids(df: DataFrame, by: Sequence[str] = TAXON) -> DataFrame:
    """Marked-up tentative identifications per taxon, each once, in the order first seen, joined by ``", "``.

    Repeats are folded before anything is collected, so a list holds one entry per distinct identification and is no longer
    than the text it becomes. Where that text is too much for one cell, ``tentative_pieces`` has it in bounded ones.
    """
    in_order = F.array_sort(F.collect_list(F.struct("first_seen", "marked")))
    lists = _first_seen(df, by).groupBy(*by).agg(in_order.alias("list"))
    return lists.select(*by, F.concat_ws(", ", F.col("list.marked")).alias("t_ids"))


def with_positions(df: DataFrame, keys: DataFrame, levels: Sequence[str] = RANKS) -> DataFrame:
    """Add each level's place in its key list: listed names first, then the others, then missing ones.

    Sorting by place and then by name puts the unlisted names in alphabetical order.
    """
    small = fits_broadcast(keys)
    rows = df
    for level in levels:
        position = POSITIONS[level]
        listed = keys.where(F.col("level") == level).select(
            F.col("name").alias(level), F.col("ordinal").alias(position)
        )
        df = keyed_join(
            df, listed, [level], "left", small=small, spread_by=["scientificName"], count_in=rows
        )
        elsewhere = F.when(F.col(level).isNull(), F.lit(MISSING)).otherwise(F.lit(UNLISTED))
        df = df.withColumn(position, F.coalesce(position, elsewhere))
    return df


def taxon_inventory(
    ranges: DataFrame,
    metrics: DataFrame | None,
    tentative: DataFrame,
    keys: DataFrame,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """One printable row per taxon, in key-list order.

    The phylum follows its list strictly: an unlisted phylum is shown blank and sorted last. The lower levels follow
    theirs leniently: unlisted names keep their text and come after the listed ones. Missing values become blank.
    ``taxon`` keeps the plain name and the ``_pos`` columns keep the order. Without ``metrics`` the first table has the
    frequency and MaxN itself, as ``occurrence.taxon_measures`` gives them.
    """
    if metrics is None:
        joined = ranges.select(*TAXON, "depth_range", "freq_occ", "max_n")
    else:
        joined = null_safe_join(ranges.select(*TAXON, "depth_range"), metrics, TAXON, "left")
    joined = null_safe_join(joined, tentative, TAXON, "left")
    placed = with_positions(joined.where(not_listed_in(F.col("scientificName"), exclude)), keys)

    unlisted_phylum = F.col("phylum_pos") >= UNLISTED
    strict = placed.withColumns(
        {
            "phylum": F.when(~unlisted_phylum, F.col("phylum")),
            "phylum_pos": F.when(unlisted_phylum, F.lit(MISSING)).otherwise(F.col("phylum_pos")),
        }
    )
    ordered = strict.orderBy(
        *[c for level, pos in POSITIONS.items() for c in (F.asc(pos), F.asc_nulls_last(level))],
        F.asc_nulls_last("scientificName"),
    )
    filled = ordered.withColumns(
        {c: blank_if_null(F.col(c)) for c in (*TAXON, "depth_range", "freq_occ", "max_n", "t_ids")}
    )
    base = marked_name(F.col("scientificName"), F.col("family"))
    with_tentative = F.concat(base, F.lit("<br>(Tentative: "), F.col("t_ids"), F.lit(")"))
    return filled.select(
        *RANKS,
        F.when(F.col("t_ids") != "", with_tentative).otherwise(base).alias("scientificName"),
        "depth_range",
        "freq_occ",
        "max_n",
        F.col("scientificName").alias("taxon"),
        *POSITIONS.values(),
    )


def labelled_inventory(inventory: DataFrame) -> DataFrame:
    """The inventory under its printed headings, helper columns left out."""
    return inventory.select(*INVENTORY_LABELS).withColumnsRenamed(INVENTORY_LABELS)
