"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from faunatally.catalog.binding import tables
from faunatally.catalog.queries import QUERIES, REPORT_NAMES, bound
from faunatally.plans.report import report
from faunatally.session import local_session, materialise

HEADLINE = (
    "merge_field_log",
    "apply_exclusions",
    "flag_effort",
    "clean_table",
    "refine_taxa",
    "richness_counts",
    "sampling_summary",
    "depth_profile",
    "compact_sightings",
    "depth_ranges",
    "attracted_metrics",
    "tentative_ids",
    "taxon_inventory",
    "distinct_phyla",
    "family_frequency",
    "order_frequency",
    "top_maxn_in",
    "top_maxn_out",
    "zone_enriched",
    "zone_taxa_top10",
    "zone_groups_top10",
    "taxa_beyond",
    "threshold_overlap",
    "report_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "faunatally-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query starts the JVM's compilers and measures the side tables
    bound(QUERIES["axis_bound"])(spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        # the noop sink computes every row and column without a collect
        bound(QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    observed = tables(spark, folder)
    for table in report(materialise(observed.clean), observed.keys, REPORT_NAMES, share=materialise).values():
        table.write.format("noop").mode("overwrite").save()
    seconds["whole_report"] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
