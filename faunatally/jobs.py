"""The two jobs from the command line, for ``spark-submit`` or ``python -m faunatally.jobs``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from faunatally.plans.preparation import prepare
from faunatally.plans.report import report
from faunatally.session import materialise
from faunatally.sources import read_clean, taxon_keys, write_results


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="faunatally", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    prep = jobs.add_parser("prepare", help="sheets and side lists to the clean table")
    prep.add_argument("--annotations", required=True)
    prep.add_argument("--annotations-format", default="parquet", choices=["parquet", "csv", "orc"])
    prep.add_argument("--field-log", required=True)
    prep.add_argument("--field-log-format", default="csv", choices=["parquet", "csv", "orc"])
    prep.add_argument("--manual-exclusions", help="CSV of records to leave out; may be absent")
    prep.add_argument("--freq-exclusions", help="CSV of deployments that do not count as effort; may be absent")
    prep.add_argument("--repeats", default="keep", choices=["keep", "raise"], help="deployments logged more than once")
    prep.add_argument("--clean", required=True, help="folder for the clean table")
    prep.add_argument("--audit", help="folder for the counts of removed records and listed deployments")

    rep = jobs.add_parser("report", help="clean table to every report table")
    rep.add_argument("--clean", required=True)
    rep.add_argument("--out", required=True, help="folder for the results, one folder per table")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"faunatally-{args.job}").getOrCreate()
    if args.job == "prepare":
        audit = prepare(
            spark,
            args.annotations,
            args.field_log,
            args.clean,
            manual_exclusions_path=args.manual_exclusions,
            freq_exclusions_path=args.freq_exclusions,
            annotations_format=args.annotations_format,
            field_log_format=args.field_log_format,
            repeats=args.repeats,
        )
        if args.audit:
            write_results(audit, args.audit)
    else:
        write_results(report(read_clean(spark, args.clean), taxon_keys(spark), share=materialise), args.out)


if __name__ == "__main__":
    main()
