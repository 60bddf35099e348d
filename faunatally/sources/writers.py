"""Sinks. Parent folders are created and earlier output is replaced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from faunatally.sources.versions import write_version


def write_clean(df: DataFrame, path: str, *, marked: str | None = None) -> None:
    """Write the clean table with all its columns, in place of an earlier one.

    A reader sees the earlier table until the new one is whole. Rows are sorted by depth within each file, which moves none
    between tasks, so that a filter on depth skips the row groups and pages of other depths. Rows that ``marked`` marks
    are written beside the table, not into it.
    """
    write_version(df, path, sort_by=["depth_m"], marked=marked)


def write_results(results: Mapping[str, DataFrame], path: str) -> None:
    """Write every result of a report to a folder of its own."""
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
