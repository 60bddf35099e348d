"""The preparation job: sheets and side lists in, clean table out."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunatally.operators.keyed_join import fits_broadcast, hot_keys, null_safe_join, repeated_keys
from faunatally.operators.occurrence import compact_sightings
from faunatally.operators.preparation import (
    NAMES,
    NO_NAME,
    Repeats,
    apply_exclusions,
    deployment_facts,
    effort_audit,
    excluded_names,
    flag_effort,
    is_excluded,
    mark_exclusions,
    merge_deployment_facts,
    merge_field_log,
    with_excluded_names,
)
from faunatally.schema import CLEAN
from faunatally.session import materialise
from faunatally.sources import (
    Scan,
    scan_annotations,
    scan_field_log,
    scan_freq_exclusions,
    scan_manual_exclusions,
    version_counts,
    write_clean,
)


class Fits(NamedTuple):
    """Which side tables were measured small enough to broadcast."""

    field_log: bool
    manual_exclusions: bool
    freq_exclusions: bool


def measure(
    field_log: DataFrame, manual_exclusions: DataFrame | None, freq_exclusions: DataFrame | None
) -> Fits:
    return Fits(*(t is None or fits_broadcast(t) for t in (field_log, manual_exclusions, freq_exclusions)))


def marked_table(
    annotations: DataFrame,
    field_log: DataFrame,
    manual_exclusions: DataFrame | None = None,
    freq_exclusions: DataFrame | None = None,
    fits: Fits | None = None,
    repeats: Repeats = "keep",
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Merge and flag, with a column ``excluded`` that marks the rows of the exclusion list.

    The side tables are measured first unless the caller has done so. Those that fit are broadcast, and the
    annotations are never shuffled. A field log too large for that is first combined with the effort list, so that the
    annotations are shuffled once on their deployment and not twice. An exclusion list too large as well comes with these facts,
    as the names of each deployment, and takes no shuffle of its own. ``count_in`` is a table with the annotations'
    deployments that is cheaper to read than they are, for counting hot ones.
    """
    if fits is None:
        fits = measure(field_log, manual_exclusions, freq_exclusions)
    if count_in is None:
        count_in = annotations
    if fits.field_log:
        merged = merge_field_log(annotations, field_log, small=True, repeats=repeats)
        flagged = flag_effort(merged, freq_exclusions, small=fits.freq_exclusions, count_in=count_in)
    elif fits.manual_exclusions or manual_exclusions is None:
        facts = deployment_facts(field_log, freq_exclusions, repeats=repeats)
        flagged = merge_deployment_facts(annotations, facts, small=False, count_in=count_in)
    else:
        excluded = excluded_names(manual_exclusions)
        facts = with_excluded_names(deployment_facts(field_log, freq_exclusions, repeats=repeats), excluded.names)
        flagged = merge_deployment_facts(annotations, facts, small=False, count_in=count_in)
        named = flagged.withColumn("__named", is_excluded()).drop(NAMES, NO_NAME)
        # records of deployments with very many excluded names, mostly none
        marked = mark_exclusions(named, excluded.many, name="__many", count_in=annotations)
        return _in_order(marked.withColumn("excluded", F.col("__named") | F.col("__many")).drop("__named", "__many"))
    marked = mark_exclusions(flagged, manual_exclusions, small=fits.manual_exclusions, count_in=annotations)
    return _in_order(marked)


def _in_order(df: DataFrame) -> DataFrame:
    """The data model's columns first, then all others of the annotation sheet."""
    return df.select(*CLEAN.names, *[c for c in df.columns if c not in CLEAN.names])


def clean_table(
    annotations: DataFrame,
    field_log: DataFrame,
    manual_exclusions: DataFrame | None = None,
    freq_exclusions: DataFrame | None = None,
    fits: Fits | None = None,
    repeats: Repeats = "keep",
    count_in: DataFrame | None = None,
) -> DataFrame:
    """``marked_table`` without the excluded rows and their mark, for use without a write.

    Excluded rows go first, so that they are not carried through the joins, unless the list comes with the log's facts. Hot
    deployments are counted before that, in ``count_in`` or the annotations, so that the exclusions are not applied a second
    time to count them.
    """
    if fits is None:
        fits = measure(field_log, manual_exclusions, freq_exclusions)
    if not (fits.field_log or fits.manual_exclusions):
        marked = marked_table(annotations, field_log, manual_exclusions, freq_exclusions, fits, repeats, count_in)
        return marked.where(~F.col("excluded")).drop("excluded")
    kept = apply_exclusions(annotations, manual_exclusions, small=fits.manual_exclusions)
    none_left = fits._replace(manual_exclusions=True)
    counted = annotations if count_in is None else count_in
    return marked_table(kept, field_log, None, freq_exclusions, none_left, repeats, counted).drop("excluded")


def clean_deployments(
    annotations: DataFrame,
    field_log: DataFrame,
    manual_exclusions: DataFrame | None = None,
    freq_exclusions: DataFrame | None = None,
    fits: Fits | None = None,
    repeats: Repeats = "keep",
) -> DataFrame:
    """The deployments of ``clean_table`` with their facts, for ``effort.deploy_meta``: its rows folded before the merge.

    What the merge and the flag add depends on the deployment alone, so each deployment with a kept row is joined once, and
    the rows themselves are not shuffled for it.
    """
    if fits is None:
        fits = measure(field_log, manual_exclusions, freq_exclusions)
    kept = apply_exclusions(annotations, manual_exclusions, small=fits.manual_exclusions).select("deployment").distinct()
    facts = deployment_facts(field_log, freq_exclusions, repeats=repeats)
    merged = null_safe_join(kept, facts, ["deployment"], "left")
    return merged.withColumn("valid_for_freq", ~F.coalesce("partial", F.lit(False))).drop("partial")


def clean_sightings(
    annotations: DataFrame,
    field_log: DataFrame,
    manual_exclusions: DataFrame | None = None,
    freq_exclusions: DataFrame | None = None,
    fits: Fits | None = None,
    repeats: Repeats = "keep",
    count_in: DataFrame | None = None,
    numbers: DataFrame | None = None,
) -> DataFrame:
    """``occurrence.compact_sightings`` of ``clean_table``.

    Beside a field log too large to broadcast the annotations are shuffled once, for the merge, the fold and a large exclusion list
    alike, as excluded records are told by what is folded. ``numbers`` (deployment, unit_no) come with the log's facts, so that ``presence_sets`` needs no join. Beside a small log
    the clean table is not shuffled and ``numbers`` are left to ``presence_sets``.
    """
    if fits is None:
        fits = measure(field_log, manual_exclusions, freq_exclusions)
    lists = (field_log, manual_exclusions, freq_exclusions)
    if fits.field_log:
        return compact_sightings(clean_table(annotations, *lists, fits, repeats, count_in))
    listed = manual_exclusions is not None and not fits.manual_exclusions
    kept, facts = annotations, deployment_facts(field_log, freq_exclusions, repeats=repeats)
    facts = facts.select("deployment", "depth_m", "substrate_type", (~F.col("partial")).alias("valid_for_freq"))
    if numbers is not None:
        numbered = numbers.withColumnsRenamed({"deployment": "__numbered"})
        met = facts.join(numbered, F.col("deployment").eqNullSafe(F.col("__numbered")), "full_outer")
        facts = met.withColumn("deployment", F.coalesce("deployment", "__numbered")).drop("__numbered")
    hot = materialise(hot_keys(annotations if count_in is None else count_in, ["deployment"]))
    if not listed:
        kept = apply_exclusions(kept, manual_exclusions, small=True)
        return compact_sightings(kept, facts, hot=hot)
    excluded = excluded_names(manual_exclusions)
    sightings = compact_sightings(kept, with_excluded_names(facts, excluded.names), hot=hot)
    return apply_exclusions(sightings.where(~is_excluded()).drop(NAMES, NO_NAME), excluded.many)


def preparation_audit(
    clean_path: str, freq_exclusions: DataFrame | None, field_log: DataFrame, scans: Mapping[str, Scan]
) -> dict[str, DataFrame]:
    """Removed records and listed deployments, as announced along the way; deployments logged more than once; cells that
    could not be read.

    The records are those of the merged table, counted from the files that were written.
    """
    spark = field_log.sparkSession
    rejected = [scan.rejected.select(F.lit(name).alias("table"), "*") for name, scan in scans.items()]
    return {
        "exclusions": version_counts(spark, clean_path),
        "effort": effort_audit(freq_exclusions, spark),
        "log_repeats": repeated_keys(field_log, ["deployment"]),
        "rejected_cells": reduce(DataFrame.unionAll, rejected),
    }


def prepare(
    spark: SparkSession,
    annotations_path: str,
    field_log_path: str,
    clean_path: str,
    *,
    manual_exclusions_path: str | None = None,
    freq_exclusions_path: str | None = None,
    annotations_format: str = "parquet",
    field_log_format: str = "csv",
    repeats: Repeats = "keep",
) -> dict[str, DataFrame]:
    """Read the sheets and the lists that exist, write the clean table, and return the audit queries.

    Kept and excluded rows are written in one pass, apart from each other, and the audit counts the written files. With
    ``repeats="raise"`` a deployment logged more than once stops the job, and an earlier clean table stays; with
    ``"keep"`` such deployments are reported before the write and their annotations repeated.
    """
    scans: dict[str, Scan | None] = {
        "annotations": scan_annotations(spark, annotations_path, annotations_format),
        "field_log": scan_field_log(spark, field_log_path, field_log_format),
        "manual_exclusions": scan_manual_exclusions(spark, manual_exclusions_path) if manual_exclusions_path else None,
        "freq_exclusions": scan_freq_exclusions(spark, freq_exclusions_path) if freq_exclusions_path else None,
    }
    found = {name: scan for name, scan in scans.items() if scan is not None}
    annotations, field_log, manual, freq = (None if s is None else s.rows for s in scans.values())
    if repeats == "keep":
        _report_repeats(field_log)
    write_clean(marked_table(annotations, field_log, manual, freq, repeats=repeats), clean_path, marked="excluded")
    return preparation_audit(clean_path, freq, field_log, found)


def _report_repeats(field_log: DataFrame, shown: int = 5) -> None:
    repeated = repeated_keys(field_log, ["deployment"]).orderBy(F.desc("rows"), "deployment").limit(shown).collect()
    if repeated:
        names = ", ".join(f"{row['deployment']} ({row['rows']} times)" for row in repeated)
        warnings.warn(f"logged more than once, annotations will be repeated: {names}", stacklevel=3)
