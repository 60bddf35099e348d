"""From annotation rows and a field log to the clean observation table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunatally.operators.keyed_join import keyed_join, mark_listed, null_safe_join, unique_keys
from faunatally.schema import ANNOTATION_DEPTH, FIELD_LOG
from faunatally.session import materialise

RECORD_KEYS = ("deployment", "scientificName")

#: Up to so many excluded names of a deployment come with its facts.
MOST_NAMES = 1000
NAMES, NO_NAME = "__excluded_names", "__no_name_excluded"


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that must be there. ``DataFrame.drop`` would pass over a misspelt name."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return df.drop(*names)


Repeats = Literal["keep", "raise"]


def _own_columns(annotations: DataFrame) -> DataFrame:
    """The annotations without their own depth; other columns that the log has too get another name."""
    if ANNOTATION_DEPTH in annotations.columns:
        annotations = drop_columns(annotations, ANNOTATION_DEPTH)
    shared = [n for n in (*FIELD_LOG.names[1:], "valid_for_freq") if n in annotations.columns]
    return annotations.withColumnsRenamed({n: f"{n}_annotated" for n in shared})


def _log_entries(field_log: DataFrame, key: str, repeats: Repeats) -> DataFrame:
    if repeats not in ("keep", "raise"):
        raise ValueError(f"repeats must be 'keep' or 'raise', not {repeats!r}")
    facts = field_log.select(key, *FIELD_LOG.names[1:])
    return unique_keys(facts, [key], "field log") if repeats == "raise" else facts


def merge_field_log(
    annotations: DataFrame,
    field_log: DataFrame,
    key: str = "deployment",
    *,
    small: bool | None = None,
    repeats: Repeats = "keep",
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Give every annotation its deployment's depth, location and substrate.

    Annotations without a log entry stay, with NULLs. The annotation sheet's own depth is dropped in favour of the
    log's; of its other columns, one that the log has too is kept as ``<name>_annotated``. A deployment logged twice
    yields its annotations twice, or with ``repeats="raise"`` fails the plan; ``repeated_keys`` finds such deployments.
    """
    entries = _log_entries(field_log, key, repeats)
    return keyed_join(_own_columns(annotations), entries, [key], "left", small=small, count_in=count_in)


def apply_exclusions(
    df: DataFrame,
    exclusions: DataFrame | None,
    keys: Sequence[str] = RECORD_KEYS,
    *,
    small: bool | None = None,
) -> DataFrame:
    """Remove the rows named by an exclusion list; without a list nothing is removed.

    A NULL key in the list removes the rows with a NULL there. The list is made distinct first.
    """
    if exclusions is None:
        return df
    return keyed_join(df, exclusions.select(*keys).distinct(), keys, "left_anti", small=small)


def mark_exclusions(
    df: DataFrame,
    exclusions: DataFrame | None,
    keys: Sequence[str] = RECORD_KEYS,
    *,
    name: str = "excluded",
    small: bool | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Mark the rows that ``apply_exclusions`` would remove, with a never-NULL boolean, and keep them all.

    Written by the mark, kept and excluded rows are counted from the files of one pass over the rows.
    """
    if exclusions is None:
        return df.withColumn(name, F.lit(False))
    return mark_listed(df, exclusions, keys, name, small=small, count_in=count_in)


def exclusion_audit(
    df: DataFrame,
    exclusions: DataFrame | None,
    keys: Sequence[str] = RECORD_KEYS,
    *,
    small: bool | None = None,
) -> DataFrame:
    """One row: how many rows there were, how many stay and how many the exclusion list removes.

    The rows are those that the list is applied to, after the merge with the field log, where a deployment logged twice
    counts twice. Counted from the key columns alone, for a table that is not written by ``mark_exclusions``; counters
    filled in as a side effect of a write would count a re-run task twice.
    """
    narrow = df.select(*keys, *[c for c in ("row_key",) if c in df.columns])
    marked = mark_exclusions(narrow, exclusions, keys, small=small)
    return marked.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~F.col("excluded")).alias("rows_after"),
        F.count_if("excluded").alias("rows_dropped"),
    )


def flag_effort(
    df: DataFrame,
    exclusions: DataFrame | None,
    key: str = "deployment",
    *,
    small: bool | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Add ``valid_for_freq``: FALSE for deployments on the list, TRUE for all others and when there is no list."""
    if exclusions is None:
        return df.withColumn("valid_for_freq", F.lit(True))
    marked = mark_listed(df, exclusions, [key], "__partial", small=small, count_in=count_in)
    return marked.withColumn("valid_for_freq", ~F.col("__partial")).drop("__partial")


def effort_audit(exclusions: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """One row: the number of list rows, as many as are announced when the flag is set; without a list, none."""
    if exclusions is None:
        spark = spark or SparkSession.active()
        return spark.range(1).select(F.lit(0).cast("bigint").alias("listed_rows"))
    return exclusions.agg(F.count(F.lit(1)).alias("listed_rows"))


def deployment_facts(
    field_log: DataFrame, exclusions: DataFrame | None, key: str = "deployment", *, repeats: Repeats = "keep"
) -> DataFrame:
    """Field log and effort flag as one table, one row per logged or listed deployment.

    Both are facts about a deployment, so one join brings both to the annotations instead of two.
    """
    facts = _log_entries(field_log, key, repeats)
    if exclusions is None:
        return facts.withColumn("partial", F.lit(False))
    listed = exclusions.select(F.col(key).alias("__listed_key")).distinct().withColumn("partial", F.lit(True))
    return (
        facts.withColumn("__logged", F.lit(True))
        .join(listed, F.col(key).eqNullSafe(F.col("__listed_key")), "full_outer")
        .select(
            F.when(F.col("__logged"), F.col(key)).otherwise(F.col("__listed_key")).alias(key),
            *FIELD_LOG.names[1:],
            F.coalesce("partial", F.lit(False)).alias("partial"),
        )
    )


def merge_deployment_facts(
    annotations: DataFrame,
    facts: DataFrame,
    key: str = "deployment",
    *,
    small: bool | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """``merge_field_log`` followed by ``flag_effort``, in one join."""
    merged = keyed_join(_own_columns(annotations), facts, [key], "left", small=small, count_in=count_in)
    return merged.withColumn("valid_for_freq", ~F.coalesce("partial", F.lit(False))).drop("partial")


class Excluded(NamedTuple):
    """An exclusion list by deployment: the names of each as one array, and the records of deployments with too many for that."""

    names: DataFrame
    many: DataFrame


def excluded_names(
    exclusions: DataFrame, keys: Sequence[str] = RECORD_KEYS, *, most: int = MOST_NAMES
) -> Excluded:
    """The list as facts about a deployment, so that the join with the other facts tells excluded records too.

    The list is made distinct and stored. Deployments with more than ``most`` names, few by that, are kept apart.
    """
    key, name = keys
    listed = materialise(exclusions.select(key, name).distinct())
    long = listed.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).select(key)
    long = F.broadcast(materialise(long))
    short = null_safe_join(listed, long, [key], "left_anti")
    names = short.groupBy(key).agg(F.collect_list(name).alias(NAMES), F.bool_or(F.col(name).isNull()).alias(NO_NAME))
    return Excluded(names, materialise(null_safe_join(listed, long, [key], "left_semi")))


def with_excluded_names(facts: DataFrame, names: DataFrame, key: str = "deployment") -> DataFrame:
    """Facts of deployments with their excluded names; deployments that only the exclusion list has are added."""
    named = names.withColumnRenamed(key, "__named_key").withColumn("__named", F.lit(True))
    met = facts.join(named, F.col(key).eqNullSafe(F.col("__named_key")), "full_outer")
    return met.withColumn(key, F.when(F.col("__named"), F.col("__named_key")).otherwise(F.col(key))).drop("__named", "__named_key")


def is_excluded(name: str = RECORD_KEYS[1]) -> Column:
    """Never NULL: is the record's name among the excluded ones of its deployment, as ``with_excluded_names`` tells them?"""
    of_no_name = F.coalesce(NO_NAME, F.lit(False))
    return F.when(F.col(name).isNull(), of_no_name).otherwise(F.coalesce(F.array_contains(NAMES, F.col(name)), F.lit(False)))
