"""Sampling effort: the deployments themselves."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.functions import half_even

# The two effort labels in legend order.
FULL_EFFORT = "Full Deployment (All Metrics)"
PARTIAL_EFFORT = "Partial Deployment (Presence/MaxN Only)"


def deploy_meta(df: DataFrame) -> DataFrame:
    """Distinct deployment attributes. Only deployments with an annotation appear."""
    return df.select("deployment", "depth_m", "substrate_type", "valid_for_freq").distinct()


def valid_effort(meta: DataFrame) -> DataFrame:
    """One row: the deployments that count for frequencies, the denominator of every overall frequency."""
    return meta.agg(F.count_if("valid_for_freq").alias("valid_deployments"))


def _bound(largest: Column, step: float) -> Column:
    return (F.ceil(largest / step) * step).cast("double")


def sampling_summary(meta: DataFrame, bound_step: float | None = None) -> DataFrame:
    """One row of totals, depth statistics and substrate counts. ``Hard/Soft`` counts as both.

    With ``bound_step`` it has the ``axis_bound`` too, from the same aggregate.
    """
    substrate = F.lower("substrate_type")
    summary = meta.agg(
        F.count(F.lit(1)).alias("total_deployments"),
        F.count_if("valid_for_freq").alias("valid_deployments"),
        half_even(F.avg("depth_m"), 1).alias("mean_depth"),
        half_even(F.stddev_samp("depth_m"), 1).alias("sd_depth"),
        F.min("depth_m").alias("min_depth"),
        F.max("depth_m").alias("max_depth"),
        F.count_if(substrate.contains("soft")).alias("n_soft"),
        F.count_if(substrate.contains("hard")).alias("n_hard"),
    )
    return summary if bound_step is None else summary.withColumn("axis_bound", _bound(F.col("max_depth"), bound_step))


def axis_bound(meta: DataFrame, step: float = 100) -> DataFrame:
    """One row: the largest depth rounded up to a full step, the lower end of the depth axis."""
    return meta.agg(_bound(F.max("depth_m"), step).alias("axis_bound"))


def depth_profile(meta: DataFrame, width: float = 100, closed: Literal["left", "right"] = "left") -> DataFrame:
    """Deployments per depth bin and effort status.

    The report draws the histogram on a reversed depth axis. Its bins are closed towards the larger plotted value,
    which on that axis is the smaller depth: ``[0, 100)``, ``[100, 200)`` and so on, with a depth on the axis bound
    itself kept in the last bin. ``closed="right"`` gives the bins of an axis that is not reversed: ``[0, 100]``,
    ``(100, 200]``.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    depth = F.col("depth_m")
    full = F.coalesce("valid_for_freq", F.lit(False))
    place = F.floor(depth / width) if closed == "left" else F.greatest(F.ceil(depth / width) - 1, F.lit(0))
    placed = (
        meta.where(depth.isNotNull())
        .select(
            place.cast("bigint").alias("bin"),
            (depth > place * width).alias("past_edge"),
            F.when(full, F.lit(1)).otherwise(F.lit(2)).alias("status_pos"),
        )
        .groupBy("bin", "past_edge", "status_pos")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if closed == "left":
        # the few counted rows tell whether the last bin holds nothing but depths on the axis bound
        last = placed.agg(F.max(F.struct("bin", "past_edge", "n"))).scalar()
        only_bound = (F.col("bin") == last["bin"]) & ~last["past_edge"] & (F.col("bin") > 0)
        placed = placed.withColumn("bin", F.when(only_bound, F.col("bin") - 1).otherwise(F.col("bin")))
    return (
        placed.groupBy("bin", "status_pos")
        .agg(F.sum("n").alias("n_deployments"))
        .select(
            "bin",
            (F.col("bin") * width).cast("double").alias("bin_from"),
            ((F.col("bin") + 1) * width).cast("double").alias("bin_to"),
            F.when(F.col("status_pos") == 1, F.lit(FULL_EFFORT))
            .otherwise(F.lit(PARTIAL_EFFORT))
            .alias("effort_status"),
            "status_pos",
            "n_deployments",
        )
        .orderBy("bin", "status_pos")
    )
