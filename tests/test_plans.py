"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import DataFrame

from faunatally.catalog.binding import Measured, Tables, tables
from faunatally.catalog.queries import QUERIES
from faunatally.plans.preparation import Fits


def plan(df: DataFrame) -> str:
    """The physical plan as first made; a query that has run shows the adapted plan before it."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


@pytest.fixture(scope="module")
def small(spark, folder):
    return tables(spark, folder)


@pytest.fixture(scope="module")
def large(spark, folder):
    return Tables(spark, folder, Measured(False, Fits(False, False, False)))


@pytest.fixture
def no_automatic_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_nested_loops_cross_joins_or_python(small, name):
    text = plan(QUERIES[name](small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEval|MapInPandas", text)


def test_small_side_tables_leave_the_annotations_in_place(small):
    text = plan(small.clean)
    assert "SortMergeJoin" not in text
    # the two shuffles make the exclusion list and the effort list distinct
    assert text.count("Exchange hashpartitioning") == 2
    assert not re.search(r"Exchange hashpartitioning\(.*individualCount", text)


def test_large_side_tables_are_joined_by_shuffle(large, no_automatic_broadcast):
    text = plan(large.clean)
    assert "SortMergeJoin" in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert "__piece" in text
    # only the hot keys, bounded in number, are broadcast
    for join in re.findall(r"BroadcastHashJoin.*", text):
        assert "__right_" in join and "Left" in join


def test_top_n_is_applied_before_the_shuffle(small):
    text = plan(QUERIES["zone_taxa_top10"](small))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(QUERIES["top_maxn_in"](small))


def test_overlap_does_not_multiply_rows(small):
    assert "Expand" not in plan(QUERIES["threshold_overlap"](small))


def test_refinement_uses_no_window(small):
    assert not re.search(r"\bWindow\b", plan(QUERIES["refine_taxa"](small)))


def test_refinement_shuffles_twice(small, monkeypatch):
    from faunatally.operators import taxonomy

    written = []
    keep = taxonomy.materialise
    monkeypatch.setattr(taxonomy, "materialise", lambda df: written.append(plan(df)) or keep(df))
    sightings = keep(QUERIES["compact_sightings"](small))
    last = plan(taxonomy.refine_taxa(sightings))
    # distinct paths, and their sizes by grouping sets; the sizes are looked up where the paths stand
    assert [text.count("Exchange hashpartitioning") for text in (*written, last)] == [1, 1, 0]
    assert "Expand" in written[1] and last.count("BroadcastHashJoin") == 5


def test_frequencies_read_the_clean_table_once(small, monkeypatch):
    from faunatally.catalog import queries

    written = []
    keep = queries.materialise
    monkeypatch.setattr(queries, "materialise", lambda df: written.append(plan(df)) or keep(df))
    last = plan(QUERIES["frequencies_from_sets"](small))
    assert sum("lineitem.parquet" in text for text in (*written, last)) == 1


def test_figures_are_three_aggregates_over_small_tables(small, spark):
    from faunatally.catalog.queries import REPORT_NAMES
    from faunatally.operators.effort import deploy_meta
    from faunatally.operators.taxonomy import refine_taxa
    from faunatally.plans.report import figures, paths_with_depths
    from faunatally.session import materialise

    sightings = materialise(QUERIES["compact_sightings"](small))
    meta, paths = materialise(deploy_meta(sightings)), materialise(paths_with_depths(sightings))
    text = plan(figures(meta, paths, refine_taxa(paths), REPORT_NAMES))
    assert "lineitem.parquet" not in text and text.count("Union") == 1


def test_scans_read_only_what_is_needed(small):
    text = plan(QUERIES["distinct_phyla"](small))
    schemas = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    # phylum by part, and the record key for the exclusion list
    assert {"l_orderkey", "l_partkey", "l_suppkey", "l_discount", "l_tax"} in schemas
    assert {"p_partkey"} < set.union(*[s for s in schemas if "p_partkey" in s])
    unused = {"l_quantity", "l_extendedprice", "l_shipdate", "p_brand", "p_type", "o_orderdate"}
    assert not any(s & unused for s in schemas)


def test_filters_reach_the_scan(small):
    text = plan(small.freq_exclusions)
    assert "EqualTo(o_orderstatus,P)" in text.split("PushedFilters:")[1]


def test_rows_are_not_shuffled_for_the_deployments(spark, folder, no_automatic_broadcast):
    # a field log too large to broadcast, as it is on large tables
    text = plan(QUERIES["deploy_meta"](Tables(spark, folder, Measured(True, Fits(False, True, False)))))
    assert "__piece" not in text
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert shuffled and not any("row_key" in keys for keys in shuffled)


def test_sightings_beside_a_large_log_are_shuffled_once(spark, folder, no_automatic_broadcast):
    """Only rows of hot deployments, which have pieces, are folded by a shuffle on the taxon."""
    text = plan(QUERIES["compact_sightings"](Tables(spark, folder, Measured(True, Fits(False, True, True)))))
    by_taxon = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "taxonRank" in line]
    assert all("__pieces" in line for line in by_taxon)
