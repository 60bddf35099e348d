"""Intermediate tables of the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from faunatally.session import materialise

# Spark's own settings: the shuffle files of a finished query are deleted at once, not when the driver collects garbage, and
# a Python task gets its rows in small portions, so a row count of long arrays can't fill a worker.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


@contextmanager
def small_portions(spark: SparkSession) -> Iterator[None]:
    """Run what is inside with ``SETTINGS``."""
    conf = spark.conf
    before = {key: conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def stored(df: DataFrame) -> DataFrame:
    """The table, written to the shared folder and read back; its shuffle files go as soon as it is written."""
    with small_portions(df.sparkSession):
        return materialise(df)
