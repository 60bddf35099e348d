"""Literal rows for the unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faunatally.schema import CLEAN

DEFAULTS = {"valid_for_freq": True}


def table(spark: SparkSession, schema: T.StructType, rows: list[dict], defaults: dict | None = None) -> DataFrame:
    """A table from partial rows; columns left out are NULL or take their default."""
    defaults = defaults or {}
    return spark.createDataFrame([tuple(r.get(n, defaults.get(n)) for n in schema.names) for r in rows], schema)


def clean(spark: SparkSession, *rows: dict) -> DataFrame:
    numbered = [{"row_key": i, **row} for i, row in enumerate(rows, start=1)]
    return table(spark, CLEAN, numbered, DEFAULTS)


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def as_set(df: DataFrame, *columns: str) -> set[tuple]:
    found = tuples(df, *columns)
    assert len(found) == len(set(found))
    return set(found)
