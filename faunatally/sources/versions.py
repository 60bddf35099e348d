"""Tables that are replaced as a whole: staged data, then a commit that names them and their schema.

``path/data/<version>`` holds a version's files and ``path/commits/<version>`` a one-row table that names it. Spark moves
that row into place only when its small job ends, after the data are whole, so a failed write leaves the earlier version
current and a reader never sees half a table. The stored schema is read back as it was, whatever the files would infer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = "place long, version string, marked string, schema string"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMITS).option("recursiveFileLookup", True).json(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _current(spark: SparkSession, path: str) -> Row | None:
    commits = _commits(spark, path)
    return None if commits is None else commits.orderBy(F.desc("place"), "version").first()


def _committed(spark: SparkSession, path: str) -> Row:
    current = _current(spark, path)
    if current is None:
        raise FileNotFoundError(f"no committed table in {path}")
    return current


def write_version(df: DataFrame, path: str, *, sort_by: Sequence[str] = (), marked: str | None = None) -> str:
    """Write a table as the new version of ``path`` and return the version's name.

    It may be computed from the current version. ``marked`` names a never-NULL boolean column that is TRUE for rows that are
    not part of the table: they are written beside it in the same pass, for ``version_counts`` and ``read_marked``.
    Superseded data stay for readers that have begun with them, until ``drop_superseded``.
    """
    spark = df.sparkSession
    before = _current(spark, path)
    version = uuid.uuid4().hex
    order = [*([marked] if marked else []), *sort_by]
    rows = df.sortWithinPartitions(*order) if order else df
    rows.write.partitionBy(*([marked] if marked else [])).parquet(f"{path}/data/{version}")
    place = 0 if before is None else before["place"] + 1
    schema = T.StructType([f for f in df.schema.fields if f.name != marked])
    commit = spark.createDataFrame([(place, version, marked, schema.json())], _COMMITS)
    commit.coalesce(1).write.json(f"{path}/commits/{version}")
    return version


def _read(spark: SparkSession, path: str, marked: bool) -> DataFrame:
    current = _committed(spark, path)
    schema = T.StructType.fromJson(json.loads(current["schema"]))
    data = f"{path}/data/{current['version']}"
    if current["marked"] is None:
        rows = spark.read.schema(schema).parquet(data)
        return rows.where(F.lit(False)) if marked else rows
    with_mark = T.StructType([*schema.fields, T.StructField(current["marked"], T.BooleanType())])
    # the mark is a folder, so only the chosen one is listed and read
    rows = spark.read.schema(with_mark).parquet(data)
    return rows.where(F.col(current["marked"]) == marked).drop(current["marked"])


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version, with the schema it was written with."""
    return _read(spark, path, False)


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    """The rows that were written beside the current version."""
    return _read(spark, path, True)


def version_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows written, rows of the table and marked rows of the current version, counted from its files.

    Written files hold each row once, whatever tasks were run again; no column is read.
    """
    current = _committed(spark, path)
    rows = spark.read.parquet(f"{path}/data/{current['version']}")
    kept = F.lit(True) if current["marked"] is None else ~F.col(current["marked"])
    return rows.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.count_if(~kept).alias("rows_dropped"),
    )


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete all versions but the current one, when no reader uses them any more. Returns their number."""
    current = _current(spark, path)
    if current is None:
        return 0
    context = spark.sparkContext
    dropped = 0
    for part in ("commits", "data"):
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        for entry in files.listStatus(folder):
            if entry.getPath().getName() != current["version"]:
                files.delete(entry.getPath(), True)
                dropped += part == "data"
    return dropped
