"""The report: every table and figure of it, as DataFrames over one clean table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.operators import effort as eff
from faunatally.operators import inventory as inv
from faunatally.operators import occurrence as occ
from faunatally.operators import taxonomy as tax
from faunatally.operators import threshold as thr
from faunatally.operators import zones as zon
from faunatally.functions import not_blank, not_listed_in
from faunatally.operators.keyed_join import repeated_keys
from faunatally.operators.presence import presence_sets, unit_numbers
from faunatally.schema import TAXON
from faunatally.sources.keys import INVENTORY_EXCLUSIONS


class ReportNames(NamedTuple):
    """The names the report asks about. The defaults are fixed values."""

    phylum: str = "Chordata"
    cartilaginous: tuple[str, ...] = ("Elasmobranchii", "Holocephali")
    not_bony: tuple[str, ...] = ("Elasmobranchii", "Holocephali", "Myxini", "Appendicularia")
    inventory_exclusions: Iterable[str] = INVENTORY_EXCLUSIONS
    threshold: float = thr.THRESHOLD


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A one-row table turned into (metric, value) rows."""
    doubles = one_row.select(*[F.col(c).cast("double").alias(c) for c in one_row.columns])
    return doubles.unpivot([], doubles.columns, "metric", "value")


def metrics_table(*one_row_tables: DataFrame) -> DataFrame:
    """All single figures as one long table."""
    return reduce(DataFrame.unionAll, [metric_rows(t) for t in one_row_tables])


def paths_with_depths(sightings: DataFrame) -> DataFrame:
    """Distinct taxonomic paths with their depth range: a table of names, from one read of the sightings."""
    return sightings.groupBy(*TAXON, "taxonRank").agg(
        F.min("depth_m").alias("min_depth"), F.max("depth_m").alias("max_depth")
    )


def figures(
    meta: DataFrame, paths: DataFrame, refined: DataFrame, names: ReportNames = ReportNames(), *, count_null: bool = True
) -> DataFrame:
    """All single figures of the report: one aggregate over the deployments, one over the names, one over the taxa.

    Each figure is a condition within its table's aggregate. The distinct counts are over the table of names, so the
    rows that Spark multiplies for them are paths, not sightings.
    """
    inside = F.col("phylum") == names.phylum
    family, order = F.col("family"), F.col("tax_order")
    bony = inside & not_listed_in(F.col("class"), names.not_bony) & not_blank(family)
    phyla = F.count_distinct("phylum")
    if count_null:
        phyla = phyla + F.coalesce(F.max(F.col("phylum").isNull().cast("int")), F.lit(0))
    of_names = paths.agg(
        F.count_distinct(F.when(bony, family)).alias("bony_families"),
        phyla.alias("n_phyla"),
        F.count_distinct(F.when(inside & not_blank(family), family)).alias("phylum_families"),
        F.count_distinct(F.when(~inside & not_blank(order), order)).alias("other_orders"),
        F.count_distinct(
            F.when((F.col("max_depth") > names.threshold) & not_blank(F.col("scientificName")), F.col("scientificName"))
        ).alias("taxa_beyond"),
    )
    of_taxa = tax.richness_counts(refined, names.phylum, {"cartilaginous_taxa": names.cartilaginous})
    of_effort = eff.sampling_summary(meta, bound_step=100)
    return metrics_table(of_effort, of_taxa, of_names)


def report(
    clean: DataFrame,
    keys: DataFrame,
    names: ReportNames = ReportNames(),
    *,
    count_null: bool = True,
    share: Callable[[DataFrame], DataFrame] = lambda df: df,
    sets: bool = False,
    sightings: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All report tables by name.

    ``share`` is applied to the tables that many results use; pass ``session.materialise`` to compute each once, so that
    the clean table is read twice: for the sightings and for the tentative identifications. ``sightings`` are those of the clean
    table where they were made before it, by ``preparation.clean_sightings``. With ``sets`` frequencies come
    from presence sets, which pays where many deployments share their taxa, else from the sightings. The report counts an unknown value as one more distinct value;
    ``count_null=False`` leaves it out.
    """
    sightings = share(occ.compact_sightings(clean) if sightings is None else sightings)
    meta = share(eff.deploy_meta(sightings))
    paths = share(paths_with_depths(sightings))
    refined = share(tax.refine_taxa(paths))
    effort = eff.valid_effort(meta)
    inside = F.col("phylum") == names.phylum
    seen = sightings
    if sets:
        seen = share(presence_sets(sightings, unit_numbers(meta), threshold=names.threshold))

    zones = share(zon.zone_effort(meta))
    zoned = zon.with_zone(seen, zones, names.phylum)
    zone_taxa = share(zon.zone_taxa(zoned, count_null=count_null))
    zone_groups = share(zon.zone_groups(zoned, count_null=count_null))
    overlap = share(thr.threshold_overlap(seen, threshold=names.threshold, count_null=count_null))
    inventory = inv.taxon_inventory(
        occ.taxon_measures(seen, effort, count_null=count_null),
        None,
        inv.tentative_ids(clean),
        keys,
        names.inventory_exclusions,
    )
    return {
        "metrics": figures(meta, paths, refined, names, count_null=count_null),
        "deploy_meta": meta,
        "deployments_repeated": repeated_keys(meta, ["deployment"]),
        "depth_profile": eff.depth_profile(meta),
        "redundancy_audit": tax.redundancy_audit(refined),
        "inventory": inventory,
        "family_frequency": occ.family_frequency(seen, names.phylum, effort, count_null=count_null),
        "order_frequency": occ.order_frequency(seen, names.phylum, effort, count_null=count_null),
        "top_maxn_inside": occ.top_max_n(seen, where=inside),
        "top_maxn_outside": occ.top_max_n(seen, where=~inside),
        "zone_effort": zones,
        "zone_taxa_fish": zon.fauna_listing(zone_taxa, zon.FISH),
        "zone_taxa_invertebrates": zon.fauna_listing(zone_taxa, zon.INVERTEBRATE),
        "zone_groups_fish": zon.fauna_listing(zone_groups, zon.FISH),
        "zone_groups_invertebrates": zon.fauna_listing(zone_groups, zon.INVERTEBRATE),
        "taxa_beyond": thr.taxa_beyond(seen, names.threshold),
        "exclusive_taxa": thr.exclusive_taxa(overlap, names.threshold),
        "shared_taxa": thr.shared_taxa(overlap),
    }
