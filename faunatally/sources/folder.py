"""Scans of folders of exported sheets: each file by its own header, every cell typed or reported, rows numbered by file.

A folder's CSV files may list their columns in any order, and some may have columns that others lack. The headers are read
first, one small job a file, into an index; files with equal headers are one scan, and the scans are united by name.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunatally.operators.numbering import block_starts, number_in_blocks
from faunatally.session import materialise

NULL_TEXT = "NA"
#: Column of the audit for a record whose number of cells is not its header's.
RECORD = "(record)"

_FILE, _START, _SLOT = "__file", "__start", "__slot"
_REJECTED = "__rejected"
_BROKEN = "__broken"
_HIDDEN = (_FILE, _START, _SLOT, _REJECTED)
_JOBS = 16

REJECTED_CELLS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("place", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)


class Scan:
    """A typed table read from files, and the cells that could not be read as their column's type.

    ``fixed`` says that the slots of rows are part of the files. Else they come from the tasks that read them, and a table
    must be stored before its slots are used twice.
    """

    def __init__(self, typed: DataFrame, *, fixed: bool = False):
        self._typed = typed
        self._fixed = fixed

    @property
    def rows(self) -> DataFrame:
        return self._typed.drop(*_HIDDEN)

    @cached_property
    def rejected(self) -> DataFrame:
        """One row per cell that is neither blank nor of its type: file, place, column and text as it stands.

        The place counts the file's records from 0, without banner and header. Asking for it reads the files again; only
        the counts of file blocks and the reported rows are joined.
        """
        marks = self._typed.select(*_HIDDEN)
        if not self._fixed:
            # a record's fault is only found when a column of it is read
            marks = materialise(self._typed.select(_named(self._typed.columns[0]), *_HIDDEN))
        starts = block_starts(marks, [_START], _SLOT, per=[_FILE])
        bad = marks.where(F.size(_REJECTED) > 0)
        placed = number_in_blocks(bad, [_START], _SLOT, "place", per=[_FILE], starts=starts)
        each = placed.select(F.col(_FILE).alias("file"), "place", F.inline(_REJECTED))
        return each.select(*REJECTED_CELLS.names)

    def without(self, *names: str) -> Scan:
        return Scan(self._typed.drop(*names), fixed=self._fixed)

    def first(self, *names: str) -> Scan:
        """The scan with the named columns first."""
        others = [c for c in self._typed.columns if c not in names]
        return Scan(self._typed.select(*map(_named, [*names, *others])), fixed=self._fixed)

    def numbered(self, name: str) -> Scan:
        """The scan with its rows numbered from 0 as they stand: files by path, and within a file as written.

        Numbers do not depend on how Spark splits the files or packs splits into tasks. Rows without fixed slots are
        stored first.
        """
        rows = self._typed if self._fixed else materialise(self._typed)
        return Scan(number_in_blocks(rows, [_FILE, _START], _SLOT, name), fixed=True)


def _named(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _first_records(spark: SparkSession, file: str, number: int) -> list[list[str]]:
    """The first records of one CSV file; a quoted line break is part of a cell."""
    wanted = number
    while True:
        lines = [row.value for row in spark.read.text(file).take(wanted)]
        whole = "\n".join(lines).count('"') % 2 == 0
        records = list(csv.reader(lines if not lines else "\n".join(lines).split("\n")))
        if len(lines) < wanted or (whole and len(records) >= number):
            return records[:number]
        wanted *= 2


def _unique(names: Sequence[str]) -> tuple[str, ...]:
    """Header cells as column names: trimmed, unnamed ones by place, repeated ones with a number."""
    out: list[str] = []
    for place, name in enumerate(names):
        name = name.strip().removeprefix("﻿").strip() or f"_c{place}"
        base, n = name, 2
        while name in out:
            name, n = f"{base}_{n}", n + 1
        out.append(name)
    return tuple(out)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files of a file, folder or pattern, in order. Only names are read."""
    return sorted(row.path for row in spark.read.format("binaryFile").load(path).select("path").collect())


def header_index(spark: SparkSession, path: str, banner: bool = False) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder by their header: its cells, as they stand, to file paths. Empty files are left out.

    With ``banner`` a file's header is its second record. The index holds names of files and columns only, as the planner
    itself does for every scan.
    """
    files = files_of(spark, path)
    with ThreadPoolExecutor(_JOBS) as pool:
        heads = list(pool.map(lambda file: _first_records(spark, file, 2 if banner else 1), files))
    index: dict[tuple[str, ...], list[str]] = {}
    for file, head in zip(files, heads):
        if len(head) > banner:
            index.setdefault(tuple(head[-1]), []).append(file)
    return index


def _text_scan(
    spark: SparkSession, header: Sequence[str], files: list[str], banner: bool, quoted_newlines: bool
) -> DataFrame:
    """One scan over the files that share a header, all cells as text.

    Spark takes the first record of each file for its header and drops it. With a banner that removes the banner, and the
    header comes through as a record that repeats the names.
    """
    names = _unique(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BROKEN)])
    rows = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, multiLine=quoted_newlines, quote='"', escape='"', columnPruning=False)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN)
        .csv(files)
        .select("*", *_position())
    )
    if not banner:
        return rows
    repeats = [F.coalesce(_named(name), F.lit("")) == cell for name, cell in zip(names, header)]
    return rows.where(~reduce(and_, repeats))


def _position() -> list[Column]:
    """Where a row stands: file, block of the file, and a number that grows by one within the block."""
    return [
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_START),
        F.monotonically_increasing_id().alias(_SLOT),
    ]


_BOUNDS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _whole(number: Column, kind: T.DataType) -> Column:
    """A decimal as an integer type: whole numbers of its range, however they are written; else NULL."""
    bound = Decimal(2 ** _BOUNDS[type(kind)])
    fits = (number == F.floor(number)) & (number >= F.lit(-bound)) & (number < F.lit(bound))
    return F.when(fits, number).cast(kind)


def typed_cell(cell: Column, have: T.DataType, want: T.DataType, null_text: str | None) -> tuple[Column, Column]:
    """A cell as its column's type, and its text if it is known but not of the type.

    Text is trimmed; blank text and ``null_text`` are NULL. A whole number counts as an integer in any form, ``3.0`` or
    ``3e2`` too; ``3.5`` does not.
    """
    if isinstance(have, T.StringType):
        cell = F.trim(cell, F.lit(" \t\r\n"))
        blank = cell == ""
        cell = F.when(~(blank if null_text is None else blank | (cell == null_text)), cell)
    if have == want:
        return cell, F.lit(None).cast("string")
    if isinstance(want, T.StringType):
        return cell.cast("string"), F.lit(None).cast("string")
    if type(want) in _BOUNDS:
        exact = cell.try_cast("decimal(38,9)")
        value = _whole(exact, want)
        if isinstance(have, (T.FloatType, T.DoubleType)):
            value = F.when(cell == F.floor(cell), value)
    else:
        value = cell.try_cast(want)
    return value, F.when(cell.isNotNull() & value.isNull(), cell.cast("string"))


def typed_rows(
    raw: DataFrame, schema: T.StructType, headings: Mapping[str, str], *, null_text: str | None, others: bool = False
) -> DataFrame:
    """The schema's columns of a raw scan, typed, with the cells that are not of their type in a hidden column.

    ``others`` keeps all further columns after them, text trimmed and blank text NULL.
    """
    renamed = raw.withColumnsRenamed(dict(headings))
    missing = [f.name for f in schema.fields if f.name not in renamed.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    columns, bad = [], []
    for field in schema.fields:
        value, text = typed_cell(_named(field.name), renamed.schema[field.name].dataType, field.dataType, null_text)
        columns.append(value.alias(field.name))
        bad.append(F.when(text.isNotNull(), F.struct(F.lit(field.name).alias("column"), text.alias("raw"))))
    if others:
        known = {*schema.names, *_HIDDEN, _BROKEN}
        for field in renamed.schema.fields:
            if field.name not in known:
                kept, _ = typed_cell(_named(field.name), field.dataType, field.dataType, null_text)
                columns.append(kept.alias(field.name))
    if _BROKEN in renamed.columns:
        broken = F.col(_BROKEN)
        bad.append(F.when(broken.isNotNull(), F.struct(F.lit(RECORD).alias("column"), broken.alias("raw"))))
    return renamed.select(*columns, _FILE, _START, _SLOT, F.array_compact(F.array(*bad)).alias(_REJECTED))


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    headings: Mapping[str, str] | None = None,
    *,
    banner: bool = False,
    quoted_newlines: bool = True,
    others: bool = False,
) -> Scan:
    """CSV files matched to the schema by the column names of each file.

    A cell may hold line breaks in quotes, for which a file is read by one task; pass ``quoted_newlines=False`` for files
    without them that are large enough to be split. Blank cells and ``NA`` are NULL.
    """
    index = header_index(spark, path, banner)
    if not index:
        raise ValueError(f"no header in {path}")
    renames = dict(headings or {})
    lacking = {}
    for header, files in index.items():
        found = {renames.get(n, n) for n in _unique(header)}
        missing = [f.name for f in schema.fields if f.name not in found]
        if missing:
            lacking[", ".join(missing)] = files[0]
    if lacking:
        raise ValueError("; ".join(f"no such column: {names} in {file}" for names, file in lacking.items()))
    scans = [
        typed_rows(
            _text_scan(spark, header, files, banner, quoted_newlines), schema, renames, null_text=NULL_TEXT, others=others
        )
        for header, files in index.items()
    ]
    return Scan(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=others), scans))


def scan_columnar(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: T.StructType,
    headings: Mapping[str, str] | None = None,
    *,
    others: bool = False,
) -> Scan:
    """Parquet, ORC or other typed files; files that lack a column of others have NULL there. ``NA`` stays text."""
    reader = spark.read.format(file_format)
    if file_format in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    position = _position()
    fixed = file_format == "parquet"
    if fixed:  # the format numbers a file's rows itself
        position[1:] = [F.lit(0).cast("long").alias(_START), F.col("_metadata.row_index").alias(_SLOT)]
    raw = reader.load(path).select("*", *position)
    return Scan(typed_rows(raw, schema, headings or {}, null_text=None, others=others), fixed=fixed)
