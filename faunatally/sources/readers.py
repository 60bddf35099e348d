"""Readers for exported sheets, side lists and the clean table.

Types are declared, never inferred. A CSV file is read as text by the names in its own header and cast, so further columns
and any column order are fine, also among the files of one folder. Blank cells and ``NA`` are NULL there, and surrounding
white space is trimmed. A cell that is not of its column's type is NULL in the rows and a row of the scan's audit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faunatally.schema import (
    ANNOTATION_DEPTH,
    ANNOTATION_HEADINGS,
    ANNOTATIONS,
    FIELD_LOG,
    FIELD_LOG_HEADINGS,
    FREQ_EXCLUSIONS,
    MANUAL_EXCLUSIONS,
)
from faunatally.sources.folder import Scan, scan_columnar, scan_csv
from faunatally.sources.versions import read_version


Found = TypeVar("Found", DataFrame, Scan)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, headings: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header line, matched to the schema by column name."""
    return scan_csv(spark, path, schema, headings).rows


def read_banner_csv(
    spark: SparkSession, path: str, schema: T.StructType, headings: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV whose files start with a banner line and have their header on the second."""
    return scan_csv(spark, path, schema, headings, banner=True).rows


def optional(read: Callable[[], Found]) -> Found | None:
    """What is read, or None when its file does not exist. Other read errors are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_annotations(
    spark: SparkSession, path: str, file_format: str = "parquet", *, quoted_newlines: bool = True
) -> Scan:
    """Annotation sheet, exported as Parquet, CSV or ORC, with all its columns but its own depth.

    Without a column ``row_key`` the rows are numbered as they stand in the files, which are taken in order of path.
    """
    numbered = T.StructType([f for f in ANNOTATIONS.fields if f.name != "row_key"])

    def scan(schema: T.StructType) -> Scan:
        if file_format == "csv":
            return scan_csv(spark, path, schema, ANNOTATION_HEADINGS, quoted_newlines=quoted_newlines, others=True)
        return scan_columnar(spark, path, file_format, schema, ANNOTATION_HEADINGS, others=True)

    found = scan(numbered)
    found = scan(ANNOTATIONS) if "row_key" in found.rows.columns else found.numbered("row_key")
    return found.without(ANNOTATION_DEPTH).first(*ANNOTATIONS.names)


def read_annotations(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The rows of ``scan_annotations``."""
    return scan_annotations(spark, path, file_format).rows


def scan_field_log(spark: SparkSession, path: str, file_format: str = "csv") -> Scan:
    """Field log. As CSV it has the banner line of the sheet; other formats carry the headings as column names."""
    if file_format == "csv":
        return scan_csv(spark, path, FIELD_LOG, FIELD_LOG_HEADINGS, banner=True)
    return scan_columnar(spark, path, file_format, FIELD_LOG, FIELD_LOG_HEADINGS)


def read_field_log(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    return scan_field_log(spark, path, file_format).rows


def scan_manual_exclusions(spark: SparkSession, path: str) -> Scan | None:
    return optional(lambda: scan_csv(spark, path, MANUAL_EXCLUSIONS))


def read_manual_exclusions(spark: SparkSession, path: str) -> DataFrame | None:
    return optional(lambda: read_csv(spark, path, MANUAL_EXCLUSIONS))


def scan_freq_exclusions(spark: SparkSession, path: str) -> Scan | None:
    return optional(lambda: scan_csv(spark, path, FREQ_EXCLUSIONS))


def read_freq_exclusions(spark: SparkSession, path: str) -> DataFrame | None:
    return optional(lambda: read_csv(spark, path, FREQ_EXCLUSIONS))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The clean table as last written, with all its columns."""
    return read_version(spark, path)
