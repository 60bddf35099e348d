"""Beside a large field log a large exclusion list comes with the log's facts and takes no shuffle of its own."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from faunatally.catalog import queries
from faunatally.operators import occurrence as occ
from faunatally.operators import preparation as prep
from faunatally.operators import presence
from faunatally.plans.preparation import Fits, clean_sightings, clean_table, marked_table
from tests.rows import clean, tuples

SMALL, LARGE = Fits(True, True, True), Fits(False, False, False)


@pytest.fixture(scope="module")
def given(spark):
    """Deployments and names that are NULL, repeated, only logged or only excluded; one deployment with many excluded names."""
    deployment = F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("d"), F.col("id") % 5))
    rows = clean(spark, {}).limit(0)
    made = spark.range(200).select(
        deployment.alias("deployment"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("n"), F.col("id") % 13)).alias("scientificName"),
        (F.col("id") % 4).cast("int").alias("individualCount"),
        F.col("id").alias("row_key"),
    )
    annotations = rows.drop("depth_m", "location", "substrate_type", "valid_for_freq").unionByName(made, allowMissingColumns=True)
    log = spark.createDataFrame(
        [("d0", 5.0, "L1", "Hard"), ("d1", None, "L2", "soft"), ("d1", 7.0, "L2", "soft"), (None, 9.0, None, None), ("d9", 1.0, "L", None)],
        "deployment string, depth_m double, location string, substrate_type string",
    )
    excluded = [("d1", None), ("d3", "n3"), ("d3", "n3"), (None, "n7"), (None, None), ("d8", "n1"), ("d4", "n0"), *[("d2", f"n{k}") for k in range(0, 13, 2)]]
    manual = spark.createDataFrame(excluded, "deployment string, scientificName string")
    freq = spark.createDataFrame([("d0",), ("d4",), ("d7",)], "deployment string")
    return annotations, log, manual, freq


def same(a, b):
    assert a.columns == b.columns
    return sorted(map(repr, tuples(a))) == sorted(map(repr, tuples(b)))


@pytest.mark.parametrize("most", [1000, 3, 0])
@pytest.mark.parametrize("make", [clean_table, marked_table, clean_sightings])
def test_large_lists_give_what_small_ones_give(given, monkeypatch, make, most):
    monkeypatch.setitem(prep.excluded_names.__kwdefaults__, "most", most)
    large, small = make(*given, LARGE), make(*given, SMALL)
    assert same(large, small)
    assert 0 < clean_table(*given, SMALL).count() < marked_table(*given, SMALL).count()


@pytest.mark.parametrize("make", [clean_table, marked_table, clean_sightings])
def test_no_shuffle_on_excluded_records(spark, given, make):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = make(*given, LARGE)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [re.sub(r"#\d+", "", found) for found in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert keys and not [k for k in keys if k.startswith("coalesce(deployment") and "scientificName" in k]


def test_metrics_make_their_sightings_once(given, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "materialise", lambda df: made.append(df) or df)
    queries.QUERIES["report_metrics"](SimpleNamespace(sightings=lambda: occ.compact_sightings(clean_table(*given, SMALL))))
    assert len(made) == 1


def test_sets_are_folded_after_the_shuffle(spark, given):
    sightings = occ.compact_sightings(clean_table(*given, SMALL)).withColumn("unit_no", F.col("individualCount").cast("long"))
    plan = presence.presence_sets(sightings, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bit_or") < plan.index("Exchange")
