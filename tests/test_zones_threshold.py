import pytest
from pyspark.sql import functions as F

from faunatally.operators import threshold as thr
from faunatally.operators import zones as zon
from faunatally.operators.effort import deploy_meta
from tests.rows import as_set, clean, tuples

SHALLOW, MIDDLE, DEEP = "<700 m", "700-1500 m", ">1500 m"


@pytest.fixture(scope="module")
def observations(spark):
    names = ("deployment", "depth_m", "phylum", "tax_order", "family", "scientificName", "valid_for_freq")
    rows = [
        ("d1", 600.0, "Chordata", "O1", "F1", "a", True),
        ("d1", 600.0, "Chordata", "O1", "F1", "a", True),
        ("d1", 600.0, "Chordata", "O1", "F2", "b", True),
        ("d2", 650.0, "Chordata", "O1", "F1", "a", True),
        ("d2", 650.0, "Mollusca", "O2", "F3", "c", True),
        ("d2", 650.0, None, "O3", "F4", "d", True),
        ("d3", 690.0, "Chordata", "O1", "F1", "z", True),
        ("d4", 100.0, "Chordata", "O1", "F1", "z", False),
        ("d5", 700.0, "Mollusca", "", "F3", "c", True),
        ("d6", 1500.5, "Mollusca", "O2", "F3", "c", True),
        ("d7", None, "Mollusca", "O2", "F3", "c", True),
        ("d6", 1500.5, "Chordata", "O1", "", "", True),
    ]
    return clean(spark, *[dict(zip(names, r)) for r in rows])


@pytest.fixture(scope="module")
def zoned(observations):
    return zon.with_zone(observations, zon.zone_effort(deploy_meta(observations)), "Chordata")


def test_zone_effort(observations):
    zones = zon.zone_effort(deploy_meta(observations))
    assert as_set(zones) == {(SHALLOW, 1, 4, 3), (MIDDLE, 2, 1, 1), (DEEP, 3, 1, 1)}


def test_with_zone(zoned):
    assert zoned.count() == 11
    groups = zoned.select("phylum", "fauna_group").distinct()
    assert as_set(groups) == {("Chordata", "Fish"), ("Mollusca", "Invertebrate"), (None, None)}
    efforts = zoned.select("depth_zone", "total_zone_deps", "valid_zone_deps").distinct()
    assert as_set(efforts) == {(SHALLOW, 4, 3), (MIDDLE, 1, 1), (DEEP, 1, 1)}


def test_zone_taxa(zoned):
    top = zon.zone_taxa(zoned)
    assert tuples(top, "depth_zone", "fauna_group", "scientificName", "occ", "freq_occ", "rank_pos") == [
        (SHALLOW, "Fish", "a", 2, 66.7, 1),
        (SHALLOW, "Fish", "b", 1, 33.3, 2),
        (SHALLOW, "Fish", "z", 1, 33.3, 3),
        (SHALLOW, "Invertebrate", "c", 1, 33.3, 1),
        (SHALLOW, None, "d", 1, 33.3, 1),
        (MIDDLE, "Invertebrate", "c", 1, 100.0, 1),
        (DEEP, "Invertebrate", "c", 1, 100.0, 1),
    ]


def test_ties_at_the_nth_place_go_by_name(zoned):
    top = zon.zone_taxa(zoned, 2)
    fish = zon.fauna_listing(top, zon.FISH)
    assert "fauna_group" not in fish.columns
    assert tuples(fish, "depth_zone", "scientificName") == [(SHALLOW, "a"), (SHALLOW, "b")]


def test_zone_groups(zoned):
    groups = zon.zone_groups(zoned)
    assert as_set(groups, "depth_zone", "fauna_group", "taxa_group", "occ") == {
        (SHALLOW, "Fish", "F1", 3),
        (SHALLOW, "Fish", "F2", 1),
        (SHALLOW, "Invertebrate", "O2", 1),
        (DEEP, "Invertebrate", "O2", 1),
    }


def test_zone_deployments_add_up(spark, folder):
    from faunatally.catalog.binding import tables

    meta = deploy_meta(tables(spark, folder).clean)
    assert (
        zon.zone_effort(meta).agg(F.sum("total_zone_deps")).first()[0]
        == meta.where("depth_m IS NOT NULL").count()
    )


@pytest.fixture(scope="module")
def deep(spark):
    names = ("scientificName", "deployment", "depth_m", "family")
    rows = [
        ("only deep", "d1", 1900.5, "F"),
        ("only deep", "d2", 2000.0, "F"),
        ("only deep", "d2", 2000.0, "F"),
        ("unplaced", "d1", 1950.0, "F"),
        ("unplaced", "d9", None, "F"),
        ("both", "d1", 1950.0, "F"),
        ("both", "d3", 1900.0, "F"),
        ("both", "d3", 10.0, "G"),
        ("shallow", "d3", 1900.0, "F"),
        ("unlabelled", None, 1950.0, "F"),
        ("", "d1", 1950.0, "F"),
        (None, "d1", 1950.0, "F"),
    ]
    return clean(spark, *[dict(zip(names, r)) for r in rows])


EXCLUSIVE, SHARED = "Exclusive to >1900m", "Shared with Shallower Depths"
SIDES = ("scientificName", "family", "n_deep_deps", "n_shallow_deps", "distribution")


def test_taxa_beyond(deep):
    assert as_set(thr.taxa_beyond(deep)) == {("only deep",), ("unplaced",), ("both",), ("unlabelled",)}


def test_overlap_ignoring_null(deep):
    assert as_set(thr.threshold_overlap(deep), *SIDES) == {
        ("only deep", "F", 2, 0, EXCLUSIVE),
        ("unplaced", "F", 1, 0, EXCLUSIVE),
        ("unlabelled", "F", 0, 0, EXCLUSIVE),
        ("both", "F", 1, 1, SHARED),
        ("both", "G", 0, 1, SHARED),
    }


def test_overlap_counting_null(deep):
    assert as_set(thr.threshold_overlap(deep, count_null=True), *SIDES) == {
        ("only deep", "F", 2, 0, EXCLUSIVE),
        ("unplaced", "F", 2, 1, SHARED),
        ("unlabelled", "F", 1, 0, EXCLUSIVE),
        ("both", "F", 1, 1, SHARED),
        ("both", "G", 0, 1, SHARED),
    }


def test_overlap_is_sorted(deep):
    overlap = thr.threshold_overlap(deep)
    assert tuples(overlap, "distribution", "min_depth", "n_deep_deps") == [
        (EXCLUSIVE, 1900.5, 2),
        (EXCLUSIVE, 1950.0, 1),
        (EXCLUSIVE, 1950.0, 0),
        (SHARED, 10.0, 0),
        (SHARED, 1900.0, 1),
    ]


def test_overlap_of_given_names(deep):
    names = deep.where("scientificName = 'shallow'").select("scientificName").distinct()
    assert as_set(thr.threshold_overlap(deep, names), *SIDES) == {("shallow", "F", 0, 1, SHARED)}


def test_other_threshold(deep):
    overlap = thr.threshold_overlap(deep, threshold=1999)
    assert as_set(overlap, *SIDES) == {("only deep", "F", 1, 1, SHARED)}
    assert thr.exclusive_taxa(overlap, 1999).count() == 0


def test_listings_split_the_overlap(spark, folder):
    from faunatally.catalog.binding import tables

    rows = tables(spark, folder).clean
    for count_null in (False, True):
        overlap = thr.threshold_overlap(rows, count_null=count_null)
        exclusive, shared = thr.exclusive_taxa(overlap), thr.shared_taxa(overlap)
        assert exclusive.columns == ["family", "scientificName", "n_deep_deps", "min_depth", "max_depth"]
        assert 0 < exclusive.count() < overlap.count()
        assert exclusive.count() + shared.count() == overlap.count()
    assert as_set(thr.taxa_beyond(rows)) == as_set(overlap.select("scientificName").distinct())
