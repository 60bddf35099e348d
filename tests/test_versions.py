"""The clean table's layout: whole or not at all, all columns, depths that can be skipped."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faunatally.sources import drop_superseded, read_clean, read_marked, version_counts, write_clean
from faunatally.sources.versions import read_version, write_version
from tests.rows import as_set, clean


def test_all_columns_survive_the_round_trip(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = clean(spark, {"deployment": "d", "depth_m": 3.5}).withColumns(
        {"Notes (free)": F.lit("x"), "tags": F.array(F.lit(1)), "seen": F.lit("2024-05-01").cast("date")}
    )
    write_clean(rows, path)
    back = read_clean(spark, path)
    assert back.dtypes == rows.dtypes and back.collect() == rows.collect()


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(clean(spark, {"deployment": "old"}), path)
    broken = clean(spark, *[{"deployment": str(k)} for k in range(50)]).withColumn(
        "deployment", F.when(F.col("deployment") == "49", F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("deployment"))
    )
    with pytest.raises(Exception, match="stop"):
        write_clean(broken, path)
    assert as_set(read_clean(spark, path), "deployment") == {("old",)}


def test_a_table_may_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.range(5), path)
    for _ in range(3):
        write_version(read_version(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert as_set(read_version(spark, path)) == {(k,) for k in range(3, 8)}
    assert drop_superseded(spark, path) == 3 and drop_superseded(spark, path) == 0
    assert as_set(read_version(spark, path)) == {(k,) for k in range(3, 8)}
    assert len(glob.glob(f"{path}/data/*")) == 1


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_version(spark, str(tmp_path / "none"))
    assert drop_superseded(spark, str(tmp_path / "none")) == 0


def test_marked_rows_stand_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = clean(spark, *[{"deployment": str(k), "depth_m": float(k)} for k in range(10)])
    write_clean(rows.withColumn("out", F.col("depth_m") > 6), path, marked="out")
    assert read_clean(spark, path).columns == rows.columns
    assert as_set(read_clean(spark, path), "deployment") == {(str(k),) for k in range(7)}
    assert as_set(read_marked(spark, path), "deployment") == {(str(k),) for k in range(7, 10)}
    assert tuple(version_counts(spark, path).first()) == (10, 7, 3)
    plan = read_clean(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(out" in plan
    # a table without marked rows
    write_clean(rows, path)
    assert tuple(version_counts(spark, path).first()) == (10, 10, 0) and read_marked(spark, path).count() == 0


def test_depths_are_sorted_within_files_for_row_groups_to_be_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200_000, numPartitions=2).select(
        F.concat(F.lit("d"), "id").alias("deployment"), (F.xxhash64("id") % 3000).cast("double").alias("depth_m")
    )
    spark.conf.set("parquet.block.size", str(256 * 1024))
    try:
        write_clean(rows, path)
    finally:
        spark.conf.unset("parquet.block.size")
    files = glob.glob(f"{path}/data/*/*.parquet")
    assert len(files) == 2
    for file in files:
        read = pq.ParquetFile(file)
        column = read.schema_arrow.names.index("depth_m")
        ranges = [read.metadata.row_group(g).column(column).statistics for g in range(read.metadata.num_row_groups)]
        assert len(ranges) > 2
        assert all(a.max <= b.min for a, b in zip(ranges, ranges[1:]))
    deep = read_clean(spark, path).where("depth_m > 2900")
    assert "GreaterThan(depth_m,2900.0)" in deep._jdf.queryExecution().executedPlan().toString()
