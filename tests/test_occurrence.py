import pytest
from pyspark.sql import functions as F

from faunatally.operators.effort import deploy_meta, valid_effort
from faunatally.operators.keyed_join import hot_keys
from faunatally.operators.occurrence import (
    attracted_metrics,
    compact_sightings,
    depth_ranges,
    distinct_phyla,
    families_excluding,
    family_count,
    family_frequency,
    frequency_of_occurrence,
    group_count,
    order_frequency,
    top_max_n,
)
from tests.rows import as_set, clean, tuples


def effort_of(n):
    return lambda spark: spark.range(1).select(F.lit(n).cast("bigint").alias("n"))


def seen(deployment, name, **more):
    return {"deployment": deployment, "scientificName": name, **more}


def test_depth_ranges(spark):
    rows = clean(
        spark,
        seen("d1", "A", depth_m=1200.0),
        seen("d2", "A", depth_m=1200.5),
        seen("d3", "A"),
        seen("d1", "B", depth_m=1200.0),
        seen("d3", "C"),
        seen("d2", "A", depth_m=3.0, phylum="P"),
    )
    got = as_set(depth_ranges(rows), "phylum", "scientificName", "min_depth", "max_depth", "depth_range")
    assert got == {
        (None, "A", 1200.0, 1200.5, "1200 - 1200.5"),
        (None, "B", 1200.0, 1200.0, "1200"),
        (None, "C", None, None, None),
        ("P", "A", 3.0, 3.0, "3"),
    }


def test_attracted_metrics(spark):
    come = {"attracted": "Attracted"}
    rows = clean(
        spark,
        seen("d1", "A", individualCount=2, **come),
        seen("d1", "A", individualCount=3, **come),
        seen("d2", "A", individualCount=9, valid_for_freq=False, **come),
        seen("d3", "A", individualCount=50, attracted="Not attracted"),
        seen("d4", "A", individualCount=50),
        seen("d2", "B", valid_for_freq=False, **come),
        seen(None, "C", individualCount=1, **come),
        seen("d1", "D", attracted="Not attracted"),
    )
    effort = effort_of(40)(spark)
    columns = ("scientificName", "freq_occ", "max_n")
    # 1 of 40 is 2.5 percent, which rounds to the even 2
    assert as_set(attracted_metrics(rows, effort), *columns) == {("A", "2", "9"), ("B", "0", None), ("C", "0", "1")}
    with_null = attracted_metrics(rows, effort, count_null=True)
    assert as_set(with_null, *columns) == {("A", "2", "9"), ("B", "0", None), ("C", "2", "1")}


def test_no_valid_deployment_gives_null_frequencies(spark):
    rows = clean(spark, seen("d1", "A", family="F", attracted="Attracted", valid_for_freq=False))
    effort = valid_effort(deploy_meta(rows))
    assert tuples(attracted_metrics(rows, effort), "freq_occ") == [(None,)]
    assert tuples(frequency_of_occurrence(rows.withColumn("valid_for_freq", F.lit(True)), "family", effort)) == [
        ("F", None)
    ]


@pytest.fixture(scope="module")
def families(spark):
    rows = [
        ("d1", "Chordata", "F1", "O1"),
        ("d1", "Chordata", "F1", "O1"),
        ("d2", "Chordata", "F1", "O1"),
        ("d3", "Chordata", "F2", None),
        (None, "Chordata", "F3", None),
        ("d3", "Chordata", "", None),
        ("d3", "Chordata", None, None),
        ("d1", "Mollusca", "F9", "O9"),
        ("d1", "Mollusca", "F9", ""),
        ("d2", None, "F8", "O8"),
    ]
    names = ("deployment", "phylum", "family", "tax_order")
    valid = [dict(zip(names, r)) for r in rows]
    partial = {"deployment": "d4", "phylum": "Chordata", "family": "F4", "valid_for_freq": False}
    return clean(spark, *valid, partial)


def test_family_frequency(spark, families):
    effort = effort_of(16)(spark)
    assert tuples(family_frequency(families, "Chordata", effort)) == [("F1", 12.5), ("F2", 6.2), ("F3", 0.0)]
    assert tuples(family_frequency(families, "Chordata", effort, count_null=True)) == [
        ("F1", 12.5),
        ("F2", 6.2),
        ("F3", 6.2),
    ]


def test_order_frequency_leaves_unknown_phyla_out(spark, families):
    assert tuples(order_frequency(families, "Chordata", effort_of(2)(spark))) == [("O9", 50.0)]


def test_counts(families):
    assert tuples(family_count(families, "Chordata")) == [(4,)]
    assert tuples(group_count(families, "Chordata")) == [(1,)]
    assert tuples(distinct_phyla(families)) == [(2,)]
    assert tuples(distinct_phyla(families, count_null=True)) == [(3,)]


def test_families_excluding_keeps_unknown_classes(spark):
    rows = [("C", "F1", "K1"), ("C", "F2", "K2"), ("C", "F3", None), ("C", "", None), ("X", "F4", None)]
    df = clean(spark, *[dict(zip(("phylum", "family", "class"), r)) for r in rows])
    assert tuples(families_excluding(df, "C", ["K1"])) == [(2,)]


def test_top_max_n_breaks_ties_by_name(spark):
    rows = [(name, n) for name, n in (("c", 5), ("b", 5), ("a", 5), ("d", 9), ("d", 1), ("e", None))]
    df = clean(spark, *[{"scientificName": s, "individualCount": n} for s, n in rows])
    assert tuples(top_max_n(df, n=3)) == [("d", 9), ("a", 5), ("b", 5)]
    assert tuples(top_max_n(df, n=3, where=F.col("scientificName") != "d")) == [("a", 5), ("b", 5), ("c", 5)]


def test_compact_sightings_serve_the_same_results(spark, folder):
    from faunatally.catalog.binding import PHYLUM, tables
    from faunatally.operators.taxonomy import refine_taxa
    from faunatally.operators.threshold import threshold_overlap

    rows = tables(spark, folder).clean
    compact = compact_sightings(rows)
    effort = valid_effort(deploy_meta(rows))
    assert compact.count() <= rows.count()
    for query in (
        deploy_meta,
        depth_ranges,
        threshold_overlap,
        refine_taxa,
        lambda df: attracted_metrics(df, effort),
        lambda df: family_frequency(df, PHYLUM, effort),
        top_max_n,
    ):
        assert as_set(query(compact)) == as_set(query(rows))


def test_frequencies_are_percentages(spark, folder):
    from faunatally.catalog.binding import tables

    rows = tables(spark, folder).clean
    freq = frequency_of_occurrence(rows, "scientificName", valid_effort(deploy_meta(rows)))
    low, high = freq.agg(F.min("freq_occ"), F.max("freq_occ")).first()
    assert 0 <= low <= high <= 100


def test_sightings_folded_before_the_merge(spark):
    """A third of the rows, and as many without a deployment, in pieces; a deployment logged twice, one not at all."""
    deployments = ["hot", None, "a", "b", "hot", None]
    rows = [(deployments[i % 6], f"N{i % 7}", ["Attracted", None][i % 2], i % 11) for i in range(240)]
    annotations = spark.createDataFrame(
        [(d, "P", None, "", "F", n, "species", a, c) for d, n, a, c in rows],
        "deployment string, phylum string, class string, tax_order string, family string, scientificName string, "
        "taxonRank string, attracted string, individualCount int",
    )
    facts = spark.createDataFrame(
        [("hot", 1.0, "Hard", True, 4), ("a", 2.0, None, False, 5), ("a", 3.0, None, False, 5), ("a", 3.0, None, False, 5)],
        "deployment string, depth_m double, substrate_type string, valid_for_freq boolean, unit_no long",
    )
    hot = hot_keys(annotations, ["deployment"], rows_per_piece=50, max_hot_keys=50)
    assert hot.count() == 2
    of = {"hot": [(1.0, "Hard", True, 4)], "a": [(2.0, None, False, 5), (3.0, None, False, 5)]}
    counts = {}
    for d, n, a, c in rows:
        for fact in of.get(d, [(None, None, True, None)]):
            key = (d, *fact[:3], "P", None, "", "F", n, "species", a)
            counts[(*key, fact[3])] = max(c, counts.get((*key, fact[3]), 0))
    found = compact_sightings(annotations, facts, hot=hot)
    assert as_set(found) == {(*key[:-1], c, key[-1]) for key, c in counts.items()}
