"""Null-safe joins that hold up when one key carries a large share of the rows.

NULL matches NULL in every join here. Spark keeps ``<=>`` an equi join, so these are hash or sort-merge joins.

Two forms are used. A right side whose measured size is under ``BROADCAST_BYTES`` is broadcast and the left side never
moves. Beyond that both sides are shuffled, and the rows of a hot key are spread: the key's rows on the left go to
``pieces`` groups and its rows on the right are repeated once per group, so no task receives a whole hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunatally.session import materialise

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_PIECE = 1_000_000
MAX_HOT_KEYS = 65_536
HASH_BUCKETS = 65_536

_RIGHT = "__right_"
_PIECES = "__pieces"
_PIECE = "__piece"
_ROWS = "__rows"
_BUCKET = "__bucket"


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes of the table by one aggregate over it; None when a column's width cannot be told."""
    widths = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            widths.append(F.lit(8))
        else:
            return None
    per_row = reduce(add, widths, F.lit(16)).cast("bigint")
    return df.agg(F.sum(per_row)).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= limit


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: _RIGHT + k for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(_RIGHT + k)) for k in keys])
    return left.join(renamed, condition, how).drop(*[_RIGHT + k for k in keys])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Plain null-safe join, for sides that are both already one row per key. The planner picks the strategy."""
    return _match(left, right, keys, how)


def hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    rows_per_piece: int = ROWS_PER_PIECE,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Keys with too many rows for one task, and the number of pieces to cut each into.

    A key is hot above ``max(rows_per_piece, total / max_hot_keys)`` rows, so there are fewer than ``max_hot_keys`` of
    them whatever the data holds. That bound is what makes the result safe to broadcast. Only the key columns are read.

    Rows are first counted by a hash of the key, in ``HASH_BUCKETS`` buckets that fold in the map tasks, and keys only
    within buckets that hold enough rows for a hot one: most tables have none, and their keys are never shuffled.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).cast("int")
    hashed = rows.select(*keys, bucket.alias(_BUCKET))
    buckets = hashed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_ROWS))
    total = buckets.agg(F.sum(_ROWS)).scalar()
    piece = F.greatest(F.lit(float(rows_per_piece)), total / F.lit(max_hot_keys))
    # a bucket has at least the rows of each of its keys; fewer than ``max_hot_keys`` can be over the limit
    full = buckets.where(F.col(_ROWS) > piece).select(_BUCKET)
    counts = hashed.join(F.broadcast(full), _BUCKET, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    return counts.where(F.col(_ROWS) > piece).select(
        *keys, F.ceil(F.col(_ROWS) / piece).cast("int").alias(_PIECES)
    )


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    hot: DataFrame,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Null-safe shuffle join with hot keys cut into pieces. Any ``how`` that keeps left rows: inner, left, semi, anti.

    ``hot`` is a result of ``hot_keys``. It decides how rows are spread, never which rows match, so it may come from an
    earlier state of the left side. ``spread_by`` names left columns that tell a hot key's rows apart. The map
    partition number is added to it, so exact copies are spread too. Both stay the same when a lost task is run again.
    """
    keys = list(keys)
    hot = F.broadcast(hot)
    piece = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), F.col(_PIECES))
    spread = (
        _match(left, hot, keys, "left")
        .withColumn(_PIECE, F.coalesce(piece.cast("int"), F.lit(0)))
        .drop(_PIECES)
    )
    repeated = (
        _match(right, hot, keys, "left")
        .withColumn(_PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)))
        .drop(_PIECES)
    )
    return _match(spread, repeated, [*keys, _PIECE], how).drop(_PIECE)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    small: bool | None = None,
    spread_by: Sequence[str] | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Join a large left side to a table of facts by key.

    ``small`` says whether the right side may be broadcast; left out, its size is measured now, which runs one
    aggregate over the right side. When it may not, the hot keys are counted now and kept as a small written table, so
    that the join itself reads the left side once. They are counted in ``count_in``, a table with the keys
    that is cheaper to read than a derived left side. ``spread_by`` defaults to ``row_key`` where the left side has one.
    """
    if small is None:
        small = fits_broadcast(right)
    if small:
        return _match(left, F.broadcast(right), keys, how)
    hot = materialise(hot_keys(left if count_in is None else count_in, keys))
    if spread_by is None:
        spread_by = [c for c in ("row_key",) if c in left.columns]
    return split_join(left, right, keys, how, hot=hot, spread_by=spread_by)


def folded_join(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    by: Sequence[str],
    folds: Mapping[str, Column],
    *,
    hot: DataFrame,
) -> DataFrame:
    """Rows folded per key and ``by``, each with the facts of its key (several rows of facts: once with each, none: NULLs).

    Rows are shuffled once, on the key: they are folded and joined where that brings them. ``hot`` is a result of
    ``hot_keys``; rows of a hot key are folded in the map tasks first and then spread by ``by``, its facts repeated. A key
    is kept as two columns that are never NULL, so that one partitioning serves both the aggregate and a plain join.
    """
    folded = [c.alias(name) for name, c in folds.items()]
    known, none = "__known_key", "__no_key"
    place = [known, none, _PIECE]

    def split(df: DataFrame) -> DataFrame:
        blank = F.lit("").cast(df.schema[key].dataType)
        return df.withColumns({known: F.coalesce(F.col(key), blank), none: F.col(key).isNull()}).drop(key)

    looked_up = _match(rows, F.broadcast(hot), [key], "left")
    cold = looked_up.where(F.col(_PIECES).isNull()).withColumn(_PIECE, F.lit(0)).drop(_PIECES)
    spread = F.pmod(F.xxhash64(*by), F.col(_PIECES)).cast("int").alias(_PIECE)
    of_hot = looked_up.where(F.col(_PIECES).isNotNull()).groupBy(key, *by, _PIECES).agg(*folded)
    every = cold.unionByName(of_hot.select(key, *by, *folds, spread))
    once = split(every).repartition(*place).groupBy(*place, *by).agg(*folded)
    repeated = _match(facts, F.broadcast(hot), [key], "left").withColumn(
        _PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1))
    )
    joined = once.join(split(repeated.drop(_PIECES)), place, "left")
    return joined.withColumn(key, F.when(~F.col(none), F.col(known))).drop(*place)


def with_group_size(
    rows: DataFrame,
    keys: Sequence[str],
    name: str,
    *,
    spread_by: Sequence[str] = (),
    rows_per_piece: int = ROWS_PER_PIECE,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Add the number of rows that share the key, NULL being a key like any other.

    Not a window, which would move every row of a key to one task. The sizes are counted with partial aggregation and
    joined back in two steps: those of the hot keys, fewer than ``max_hot_keys``, by broadcast, the rest by shuffle.
    Rows of a hot key need nothing from the second join and are spread over its tasks.
    """
    keys = list(keys)
    total = rows.agg(F.count(F.lit(1))).scalar()
    hot_above = F.greatest(F.lit(float(rows_per_piece)), total / F.lit(max_hot_keys))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    hot = sizes.where(F.col(_ROWS) > hot_above).withColumnRenamed(_ROWS, name)
    cold = sizes.where(F.col(_ROWS) <= hot_above).withColumn(_PIECE, F.lit(0))
    elsewhere = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), F.lit(MAX_HOT_KEYS)).cast("int") + 1
    looked_up = _match(rows, F.broadcast(hot), keys, "left").withColumn(
        _PIECE, F.when(F.col(name).isNull(), F.lit(0)).otherwise(elsewhere)
    )
    return (
        _match(looked_up, cold, [*keys, _PIECE], "left")
        .withColumn(name, F.coalesce(name, _ROWS))
        .drop(_PIECE, _ROWS)
    )


def mark_listed(
    df: DataFrame,
    listed: DataFrame,
    keys: Sequence[str],
    name: str,
    *,
    small: bool | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Add a never-NULL boolean: does the row's key occur in ``listed``?"""
    marker = "__listed"
    distinct = listed.select(*keys).distinct().withColumn(marker, F.lit(True))
    marked = keyed_join(df, distinct, keys, "left", small=small, count_in=count_in)
    present: Column = F.col(marker).isNotNull()
    return marked.withColumn(name, present).drop(marker)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on more than one row, with their row count. Empty for a table that is unique on them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The table, which must have one row per key: the plan fails on the first key that has more, NULL being a key too.

    The test is part of the plan, so nothing that depends on the table can be written before it has passed.
    """
    others = [c for c in df.columns if c not in keys]
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_ROWS), F.max(F.struct(*others) if others else F.lit(0)).alias("__others")
    )
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"{what}: "), F.col(_ROWS).cast("string"), F.lit(f" rows for {', '.join(keys)} = "), shown)
    single = F.when(F.col(_ROWS) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return folded.where(single).select(*keys, *[F.col("__others")[c].alias(c) for c in others]).select(*df.columns)
