"""Queries that write the bound tables to files as sheets are exported, and read them back with the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.catalog.binding import Tables
from faunatally.schema import ANNOTATIONS, FIELD_LOG_HEADINGS
from faunatally.sources import (
    read_annotations,
    read_clean,
    read_csv,
    read_field_log,
    read_marked,
    version_counts,
    write_clean,
)

LOGS = 4


def annotations_from_csv(t: Tables) -> DataFrame:
    """The annotations by way of CSV files in one folder, of which every other has its columns in reverse."""
    path = t.new_folder("annotations")
    # a count comes as 3.0 from sheets, and a blank family is a blank cell
    sheet = t.annotations.withColumn("individualCount", F.col("individualCount").cast("double"))
    names = sheet.columns
    for odd, columns in enumerate((names, names[::-1])):
        part = sheet.where(F.pmod(F.xxhash64("row_key"), F.lit(2)) == odd).select(*columns)
        part.withColumnRenamed("tax_order", "order").write.mode("append").csv(path, header=True, escape='"')
    return read_annotations(t.spark, path, "csv").select(*ANNOTATIONS.names)


def field_log_from_csv(t: Tables) -> DataFrame:
    """The field log by way of several CSV files with a banner and with their columns in two orders."""
    path = t.new_folder("log")
    headings = {model: sheet for sheet, model in FIELD_LOG_HEADINGS.items()}
    log = t.field_log.withColumn("part", F.pmod(F.xxhash64("deployment", "location"), F.lit(LOGS)))
    lines = []
    for odd, columns in enumerate((list(headings), list(headings)[::-1])):
        heads = t.spark.range(LOGS).where(F.col("id") % 2 == odd).select(
            F.col("id").alias("part"),
            F.posexplode(F.array(F.lit("Group A,,,"), F.lit(",".join(headings[c] for c in columns)))).alias("at", "value"),
        )
        rows = log.where(F.col("part") % 2 == odd).select("part", F.lit(2).alias("at"), F.to_csv(F.struct(*columns)).alias("value"))
        lines.append(heads.unionAll(rows))
    every = lines[0].unionAll(lines[1]).repartition("part").sortWithinPartitions("part", "at")
    every.select("part", "value").write.partitionBy("part").text(path)
    return read_field_log(t.spark, path)


def clean_table_written(t: Tables) -> DataFrame:
    """The clean table with all columns, written twice and read back."""
    path = t.new_folder("clean")
    write_clean(t.clean_all_columns.limit(0), path)
    write_clean(t.clean_all_columns, path)
    return read_clean(t.spark, path)


def written_counts(t: Tables) -> DataFrame:
    """Rows kept and excluded, with a field log that has some deployments twice, counted from one marked write."""
    path = t.new_folder("marked")
    write_clean(t.marked(t.repeated_log), path, marked="excluded")
    return version_counts(t.spark, path)


def written_exclusions(t: Tables) -> DataFrame:
    """The excluded rows as they stand beside the written table."""
    path = t.new_folder("marked")
    write_clean(t.marked(t.repeated_log), path, marked="excluded")
    return read_marked(t.spark, path)


def listed_deployments(t: Tables) -> DataFrame:
    """The effort list by way of a CSV file."""
    path = t.new_folder("listed")
    t.freq_exclusions.write.csv(path, header=True)
    return read_csv(t.spark, path, t.freq_exclusions.schema)
