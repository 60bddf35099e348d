"""The registered queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunatally.catalog import files
from faunatally.catalog.binding import (
    DISPLAY_EXCLUSIONS,
    EXCLUDED_CLASSES,
    PHYLUM,
    RICHNESS_CLASSES,
    Tables,
    tables,
)
from faunatally.operators import effort as eff
from faunatally.operators import inventory as inv
from faunatally.operators import occurrence as occ
from faunatally.operators import preparation as prep
from faunatally.operators import taxonomy as tax
from faunatally.operators import threshold as thr
from faunatally.operators import zones as zon
from faunatally.operators.presence import presence_sets, unit_numbers
from faunatally.plans.report import ReportNames, metrics_table, report
from faunatally.session import materialise

REPORT_NAMES = ReportNames(PHYLUM, RICHNESS_CLASSES, EXCLUDED_CLASSES, DISPLAY_EXCLUSIONS)

Query = Callable[[Tables], DataFrame]


def _meta(t: Tables) -> DataFrame:
    return eff.deploy_meta(t.clean_deployments)


def _effort(t: Tables) -> DataFrame:
    return eff.valid_effort(_meta(t))


def _refined(t: Tables) -> DataFrame:
    return tax.refine_taxa(t.clean)


def _zoned(t: Tables) -> DataFrame:
    return zon.with_zone(t.clean, zon.zone_effort(_meta(t)), PHYLUM)


def _fine(t: Tables) -> DataFrame:
    """Depths that no short binary fraction holds."""
    return t.clean.withColumn("depth_m", F.col("depth_m") * 0.1)


def _numbered_sightings(t: Tables, *, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """The sightings and the numbers of their deployments, which come with a large field log or are made after the merge.

    They are stored, unless the caller reads them ``once`` and nothing else does.
    """
    if not isinstance(t, Tables) or t.fits.field_log:  # a clean table alone has no log
        sightings = materialise(t.sightings() if isinstance(t, Tables) else occ.compact_sightings(t.clean))
        return sightings, unit_numbers(sightings)
    # excluded deployments may have numbers too, and need no merge to be left out
    numbers = unit_numbers(t.lines)
    sightings = t.sightings(numbers)
    return sightings if once else materialise(sightings), numbers


def _sets(sightings: DataFrame, numbers: DataFrame) -> DataFrame:
    return materialise(presence_sets(sightings, numbers, threshold=thr.THRESHOLD))


def _inventory_from_sets(t: Tables) -> DataFrame:
    """Ranges, frequencies and the effort from one table of sightings and one of sets."""
    sightings, numbers = _numbered_sightings(t)
    sets = _sets(sightings, numbers)
    return inv.taxon_inventory(
        occ.depth_ranges(sets),
        occ.attracted_metrics(sets, eff.valid_effort(eff.deploy_meta(sightings))),
        inv.tentative_ids(t.clean),
        t.keys,
        DISPLAY_EXCLUSIONS,
    )


def _frequencies(t: Tables) -> DataFrame:
    """Every frequency of the report, overall and by zone, from one table of presence sets."""
    sightings, numbers = _numbered_sightings(t)
    meta = eff.deploy_meta(sightings)
    sets = _sets(sightings, numbers)
    effort = eff.valid_effort(meta)
    zoned = zon.with_zone(sets, zon.zone_effort(meta), PHYLUM)
    rows = [
        occ.family_frequency(sets, PHYLUM, effort, count_null=True).withColumnRenamed("family", "taxon"),
        occ.order_frequency(sets, PHYLUM, effort, count_null=True).withColumnRenamed("tax_order", "taxon"),
        zon.zone_taxa(zoned, count_null=True).withColumnRenamed("scientificName", "taxon"),
        zon.zone_groups(zoned, count_null=True).withColumnRenamed("taxa_group", "taxon"),
    ]
    kinds = ("family", "order", "zone taxon", "zone group")
    columns = ["kind", "depth_zone", "fauna_group", "taxon", "occ", "freq_occ"]
    named = [r.withColumn("kind", F.lit(k)) for r, k in zip(rows, kinds)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).select(*columns)


def _inventory(t: Tables, clean: DataFrame | None = None) -> DataFrame:
    return inv.taxon_inventory(
        occ.taxon_measures(t.clean if clean is None else clean, _effort(t)),
        None,
        inv.tentative_ids(t.clean),
        t.keys,
        DISPLAY_EXCLUSIONS,
    )


def _metrics(t: Tables) -> DataFrame:
    sightings = materialise(t.sightings())
    return metrics_table(
        eff.sampling_summary(eff.deploy_meta(sightings)),
        tax.richness_counts(tax.refine_taxa(sightings), PHYLUM),
        occ.distinct_phyla(sightings),
        occ.group_count(sightings, PHYLUM),
        thr.taxa_beyond(sightings).agg(F.count(F.lit(1)).alias("taxa_beyond")),
    )


QUERIES: dict[str, Query] = {
    "merge_field_log": lambda t: prep.merge_field_log(
        t.annotations, t.field_log, small=t.fits.field_log, count_in=t.lines
    ),
    "apply_exclusions": lambda t: prep.apply_exclusions(
        t.annotations, t.manual_exclusions, small=t.fits.manual_exclusions
    ),
    "exclusion_audit": lambda t: prep.exclusion_audit(
        prep.merge_field_log(t.annotations, t.field_log, small=t.fits.field_log, count_in=t.lines),
        t.manual_exclusions,
        small=t.fits.manual_exclusions,
    ),
    "exclusion_audit_of_repeats": lambda t: prep.exclusion_audit(
        prep.merge_field_log(t.annotations, t.repeated_log, small=t.fits.field_log, count_in=t.lines),
        t.manual_exclusions,
        small=t.fits.manual_exclusions,
    ),
    "written_counts": files.written_counts,
    "written_exclusions": files.written_exclusions,
    "merge_unique_log": lambda t: prep.merge_field_log(
        t.annotations, t.field_log, small=t.fits.field_log, repeats="raise", count_in=t.lines
    ),
    "flag_effort": lambda t: prep.flag_effort(t.annotations, t.freq_exclusions, small=t.fits.freq_exclusions),
    "effort_audit": lambda t: prep.effort_audit(t.freq_exclusions),
    "flag_effort_without_list": lambda t: prep.flag_effort(t.annotations, None),
    "clean_table": lambda t: t.clean,
    "clean_table_all_columns": lambda t: t.clean_all_columns,
    "clean_table_written": files.clean_table_written,
    "annotations_from_csv": files.annotations_from_csv,
    "field_log_from_csv": files.field_log_from_csv,
    "listed_deployments": files.listed_deployments,
    "refine_taxa": _refined,
    "refine_taxa_normalised": lambda t: tax.refine_taxa(t.clean, normalise_first=True),
    "true_richness": lambda t: tax.true_richness(_refined(t)).select(*tax.TAXON, "taxonRank"),
    "richness_counts": lambda t: tax.richness_counts(_refined(t), PHYLUM),
    "redundancy_audit": lambda t: tax.redundancy_audit(_refined(t)),
    "class_richness": lambda t: tax.class_richness(_refined(t), RICHNESS_CLASSES),
    "deploy_meta": _meta,
    "sampling_summary": lambda t: eff.sampling_summary(_meta(t)),
    "depth_profile": lambda t: eff.depth_profile(_meta(t)),
    "depth_profile_right_closed": lambda t: eff.depth_profile(_meta(t), closed="right"),
    "axis_bound": lambda t: eff.axis_bound(_meta(t)),
    "compact_sightings": lambda t: t.sightings(),
    "depth_ranges": lambda t: occ.depth_ranges(t.clean),
    "attracted_metrics": lambda t: occ.attracted_metrics(t.clean, _effort(t)),
    "taxon_measures": lambda t: occ.taxon_measures(t.clean, _effort(t)),
    "attracted_metrics_with_null": lambda t: occ.attracted_metrics(t.clean, _effort(t), count_null=True),
    "depth_ranges_fine": lambda t: occ.depth_ranges(_fine(t)),
    "tentative_listing": lambda t: inv.tentative_listing(t.clean),
    "tentative_pieces": lambda t: inv.tentative_pieces(inv.tentative_listing(t.clean), size=2),
    "tentative_ids": lambda t: inv.tentative_ids(t.clean),
    "taxon_inventory": _inventory,
    "taxon_inventory_fine": lambda t: _inventory(t, _fine(t)),
    "inventory_labels": lambda t: inv.labelled_inventory(_inventory(t)),
    "families_excluding": lambda t: occ.families_excluding(t.clean, PHYLUM, EXCLUDED_CLASSES),
    "distinct_phyla": lambda t: occ.distinct_phyla(t.clean),
    "distinct_phyla_with_null": lambda t: occ.distinct_phyla(t.clean, count_null=True),
    "family_count": lambda t: occ.family_count(t.clean, PHYLUM),
    "order_count": lambda t: occ.group_count(t.clean, PHYLUM),
    "family_frequency": lambda t: occ.family_frequency(t.clean, PHYLUM, _effort(t)),
    "family_frequency_with_null": lambda t: occ.family_frequency(t.clean, PHYLUM, _effort(t), count_null=True),
    "order_frequency": lambda t: occ.order_frequency(t.clean, PHYLUM, _effort(t)),
    "order_frequency_with_null": lambda t: occ.order_frequency(t.clean, PHYLUM, _effort(t), count_null=True),
    "top_maxn_in": lambda t: occ.top_max_n(t.clean, where=F.col("phylum") == PHYLUM),
    "top_maxn_out": lambda t: occ.top_max_n(t.clean, where=F.col("phylum") != PHYLUM),
    "zone_effort": lambda t: zon.zone_effort(_meta(t)),
    "zone_enriched": _zoned,
    "zone_taxa_top10": lambda t: zon.zone_taxa(_zoned(t)),
    "zone_groups_top10": lambda t: zon.zone_groups(_zoned(t)),
    "zone_taxa_with_null": lambda t: zon.zone_taxa(_zoned(t), count_null=True),
    "zone_groups_with_null": lambda t: zon.zone_groups(_zoned(t), count_null=True),
    "zone_fish": lambda t: zon.fauna_listing(zon.zone_taxa(_zoned(t)), zon.FISH),
    "zone_inverts": lambda t: zon.fauna_listing(zon.zone_taxa(_zoned(t)), zon.INVERTEBRATE),
    "zone_fish_families": lambda t: zon.fauna_listing(zon.zone_groups(_zoned(t)), zon.FISH),
    "zone_invert_orders": lambda t: zon.fauna_listing(zon.zone_groups(_zoned(t)), zon.INVERTEBRATE),
    "taxa_beyond": lambda t: thr.taxa_beyond(t.clean),
    "threshold_overlap": lambda t: thr.threshold_overlap(t.clean),
    "threshold_overlap_with_null": lambda t: thr.threshold_overlap(t.clean, count_null=True),
    "threshold_overlap_of_names": lambda t: thr.threshold_overlap(t.clean, thr.taxa_beyond(t.clean)),
    "exclusive_taxa": lambda t: thr.exclusive_taxa(thr.threshold_overlap(t.clean)),
    "shared_taxa": lambda t: thr.shared_taxa(thr.threshold_overlap(t.clean)),
    "report_metrics": _metrics,
    "report_figures": lambda t: report(t.clean, t.keys, REPORT_NAMES, share=materialise, sightings=t.sightings())["metrics"],
    "frequencies_from_sets": _frequencies,
    "overlap_from_sets": lambda t: thr.threshold_overlap(_sets(*_numbered_sightings(t, once=True)), count_null=True),
    "inventory_from_sets": _inventory_from_sets,
}


def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tables(spark, folder))

    return run
