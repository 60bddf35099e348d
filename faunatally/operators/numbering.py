"""Consecutive row numbers without bringing the rows to one task.

Rows are laid out in blocks whose order is known: splits of files, or partitions of a range partitioning. The rows of every
block are counted, a running sum over the counts gives each block the number of its first row, and a row's number is that
plus its place in the block. Only the counts, one row per block, are ever brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faunatally.operators.keyed_join import keyed_join
from faunatally.session import materialise

_SLOT = "__slot"
_BLOCK = "__block"
_FIRST = "__first"
_BEFORE = "__before"


def block_starts(rows: DataFrame, block: Sequence[str], slot: str, *, per: Sequence[str] = ()) -> DataFrame:
    """One row per block: its first slot, and how many rows of its ``per`` value come in earlier blocks."""
    before = Window.partitionBy(*per).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*per, *block)
        .agg(F.min(slot).alias(_FIRST), F.count(F.lit(1)).alias("__n"))
        .withColumn(_BEFORE, F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )


def number_in_blocks(
    rows: DataFrame,
    block: Sequence[str],
    slot: str,
    name: str,
    *,
    per: Sequence[str] = (),
    starts: DataFrame | None = None,
) -> DataFrame:
    """Number rows from 0 by block and place in it, anew for each value of ``per``.

    ``slot`` grows by one from row to row of a block. ``rows`` must be a stored table: it is read twice, and both
    times must show the same slots. The running sum is over one row per block, so its one task sees no data rows.
    Give the ``block_starts`` of a whole table to number some of its rows.
    """
    if starts is None:
        starts = block_starts(rows, block, slot, per=per)
    placed = keyed_join(rows, starts, [*per, *block], "left", spread_by=[slot])
    return placed.withColumn(name, F.col(_BEFORE) + F.col(slot) - F.col(_FIRST)).drop(_BEFORE, _FIRST)


def number_sorted(rows: DataFrame, order: Sequence[Column | str], name: str, *, per: Sequence[str] = ()) -> DataFrame:
    """Number rows from 0 in sort order, anew for each value of ``per``, which may hold most of the rows.

    The rows are range partitioned, so a large group spreads over many tasks, and stored once. Equal rows are numbered
    in any order; add columns to ``order`` until rows that differ are told apart. NULLs come first.
    """
    keys = [*per, *order]
    laid = materialise(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_SLOT, F.monotonically_increasing_id())
    ).withColumn(_BLOCK, F.shiftright(_SLOT, 33))
    return number_in_blocks(laid, [_BLOCK], _SLOT, name, per=per).drop(_SLOT, _BLOCK)
