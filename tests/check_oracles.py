"""Compare every registered query with its SQL on one data folder.

Run as ``python -m tests.check_oracles FOLDER [NAME ...]``; the test suite uses ``compare`` on the small folder.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, int):
        return (2, repr(value))
    return (3, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark's names of the types in use, and the checking engine's.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same columns, types and rows; else what differs."""
    got_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    want_types = {row[0]: row[1] for row in connection.execute("DESCRIBE " + sql).fetchall()}
    if got_types != want_types:
        return f"types {set(got_types.items()) ^ set(want_types.items())}"
    cursor = connection.execute(sql)
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}; extra {extra}; lacking {lacking}"
    return None


def main(folder: str, *names: str) -> int:
    import __spark_entry__ as contract
    from faunatally.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = compare(query(spark, folder), connection, sql[name])
        except Exception as error:  # report every query, not only the first that breaks
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
