"""Which recorded names are taxa of their own, and how many there are."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.functions import blank_if_null, first_word, listed_in
from faunatally.operators.keyed_join import fits_broadcast, keyed_join
from faunatally.schema import RANKS, TAXON
from faunatally.session import materialise

# rank name as recorded -> (column that groups it, name of its count)
RANK_GROUPS = {
    "phylum": ("phylum", "n_phylum"),
    "class": ("class", "n_class"),
    "order": ("tax_order", "n_order"),
    "family": ("family", "n_family"),
    "genus": ("first_word", "n_genus"),
}


def taxon_paths(df: DataFrame, *, normalise_first: bool = False) -> DataFrame:
    """Distinct taxonomic paths with their rank, missing ranks as blank text.

    Paths that differ only in NULL against blank stay two rows, as de-duplication comes first; ``normalise_first``
    swaps the two steps. ``missing_ranks`` tells such rows apart: one bit per rank that was NULL.
    """
    paths = df.select(*TAXON, "taxonRank")
    blanks = {rank: blank_if_null(F.col(rank)) for rank in RANKS}
    if normalise_first:
        return paths.withColumns(blanks).distinct().withColumn("missing_ranks", F.lit(0))
    bits = [F.col(rank).isNull().cast("int") * (1 << i) for i, rank in enumerate(RANKS)]
    return paths.distinct().withColumns({"missing_ranks": reduce(add, bits), **blanks})


def group_sizes(paths: DataFrame) -> DataFrame:
    """(grouping, value, size): the number of paths of each phylum, class, order, family and first word, NULL being a value.

    All five counts are one aggregate over grouping sets, folded in the map tasks, so a group with most of the paths is
    counted by many.
    """
    columns = [key for key, _ in RANK_GROUPS.values()]
    sized = paths.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.grouping_id().alias("__without"), F.count(F.lit(1)).alias("size")
    )
    # the bit of a column is 0 in the set it makes
    every = (1 << len(columns)) - 1
    place = {c: every - (1 << (len(columns) - 1 - k)) for k, c in enumerate(columns)}
    grouping, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (key, name), bits in zip(RANK_GROUPS.values(), place.values()):
        own = F.col("__without") == bits
        grouping, value = F.when(own, F.lit(name)).otherwise(grouping), F.when(own, F.col(key)).otherwise(value)
    return sized.select(grouping.alias("grouping"), value.alias("value"), "size")


def refine_taxa(df: DataFrame, *, normalise_first: bool = False) -> DataFrame:
    """Every distinct path with the size of its five groups and whether it is redundant.

    A path is redundant when other paths share its own rank's group: a family-level record beside any record of that
    family, a genus-level record beside one of its species. Blank ranks form one group across all phyla.

    The paths, a table of names and not of records, are made distinct by one shuffle and kept; their groups are sized by a
    second, and the sizes looked up. Nothing is multiplied by five or brought together again per path. Sizes that are
    too large to broadcast are joined by shuffle, with hot groups split.
    """
    paths = materialise(
        taxon_paths(df, normalise_first=normalise_first).withColumn("first_word", first_word(F.col("scientificName")))
    )
    sizes = materialise(group_sizes(paths))
    small = fits_broadcast(sizes)
    sized = paths
    for key, name in RANK_GROUPS.values():
        of_level = sizes.where(F.col("grouping") == name).select(F.col("value").alias(key), F.col("size").alias(name))
        sized = keyed_join(sized, of_level, [key], "left", small=small, spread_by=["scientificName"], count_in=paths)
    own_rank_shared = [
        (F.col("rank_clean") == rank) & (F.col(size) > 1) for rank, (_, size) in RANK_GROUPS.items()
    ]
    return (
        sized.select(*[c for c in paths.columns if c != "missing_ranks"], *[name for _, name in RANK_GROUPS.values()])
        .withColumn("rank_clean", F.lower("taxonRank"))
        .withColumn("is_redundant", F.coalesce(reduce(or_, own_rank_shared), F.lit(False)))
    )


def true_richness(refined: DataFrame) -> DataFrame:
    """The paths that count as taxa of their own."""
    return refined.where(~F.col("is_redundant"))


def richness_counts(
    refined: DataFrame, phylum: str, of_classes: Mapping[str, Iterable[str]] | None = None
) -> DataFrame:
    """One row: taxa in all, in the phylum, and outside it. A path of unknown phylum counts as outside.

    ``of_classes`` adds counts of the taxa of listed classes, by name of the count.
    """
    inside = F.col("phylum") == phylum
    return true_richness(refined).agg(
        F.count(F.lit(1)).alias("total_taxa"),
        F.count_if(inside).alias("phylum_taxa"),
        F.count_if(~inside).alias("other_taxa"),
        *[F.count_if(listed_in(F.col("class"), listed)).alias(name) for name, listed in (of_classes or {}).items()],
    )


def redundancy_audit(refined: DataFrame) -> DataFrame:
    """The paths left out of the richness counts, for review."""
    return refined.where("is_redundant").select("scientificName", "family", "taxonRank")


def class_richness(refined: DataFrame, classes: Iterable[str]) -> DataFrame:
    """One row: taxa whose class is in the list."""
    return true_richness(refined).agg(F.count_if(listed_in(F.col("class"), classes)).alias("n_taxa"))
