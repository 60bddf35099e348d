import pytest

from faunatally.operators.effort import (
    FULL_EFFORT,
    PARTIAL_EFFORT,
    axis_bound,
    deploy_meta,
    depth_profile,
    sampling_summary,
    valid_effort,
)
from tests.rows import as_set, clean, tuples


def deployments(spark, *rows):
    names = ("deployment", "depth_m", "substrate_type", "valid_for_freq")
    return deploy_meta(clean(spark, *[dict(zip(names, r)) for r in rows]))


@pytest.fixture(scope="module")
def meta(spark):
    return deployments(
        spark,
        ("d1", 100.0, "Hard", True),
        ("d1", 100.0, "Hard", True),
        ("d2", 200.5, "SOFT", True),
        ("d3", None, "Hard/Soft", False),
        (None, 300.0, None, True),
    )


def test_deploy_meta_is_distinct_and_keeps_nulls(meta):
    assert meta.count() == 4
    assert tuples(valid_effort(meta)) == [(3,)]


def test_two_metadata_rows_of_a_deployment_both_count(spark):
    twice = deployments(spark, ("d1", 100.0, "Hard", True), ("d1", 110.0, "Hard", True))
    assert tuples(valid_effort(twice)) == [(2,)]


def test_sampling_summary(meta):
    row = sampling_summary(meta).first()
    assert row.asDict() == {
        "total_deployments": 4,
        "valid_deployments": 3,
        "mean_depth": 200.2,
        "sd_depth": 100.0,
        "min_depth": 100.0,
        "max_depth": 300.0,
        "n_soft": 2,
        "n_hard": 2,
    }


def test_standard_deviation_of_one_depth_is_null(spark):
    assert sampling_summary(deployments(spark, ("d1", 5.0, None, True))).first().sd_depth is None


EDGES = [0.0, 99.5, 100.0, 100.5, 199.5, 200.0, 300.0]


def profile(spark, depths, **options):
    rows = [(f"d{i}", d, None, True) for i, d in enumerate(depths)]
    bins = {}
    for place, n in tuples(depth_profile(deployments(spark, *rows), **options), "bin", "n_deployments"):
        bins[place] = n
    return bins


def test_bins_are_closed_towards_the_surface(spark):
    assert profile(spark, EDGES) == {0: 2, 1: 3, 2: 2}
    assert profile(spark, [*EDGES, 300.5]) == {0: 2, 1: 3, 2: 1, 3: 2}


def test_bins_of_an_axis_that_is_not_reversed(spark):
    assert profile(spark, EDGES, closed="right") == {0: 3, 1: 3, 2: 1}


def test_bins_of_surface_deployments_only(spark):
    assert profile(spark, [0.0, 0.0]) == {0: 2}


def test_profile_splits_by_effort_and_drops_unknown_depths(spark):
    meta = deployments(
        spark, ("a", 10.0, None, True), ("b", 20.0, None, False), ("c", None, None, True), ("d", 120.0, None, True)
    )
    assert tuples(depth_profile(meta)) == [
        (0, 0.0, 100.0, FULL_EFFORT, 1, 1),
        (0, 0.0, 100.0, PARTIAL_EFFORT, 2, 1),
        (1, 100.0, 200.0, FULL_EFFORT, 1, 1),
    ]
    with pytest.raises(ValueError):
        depth_profile(meta, closed="both")


def test_axis_bound(spark, meta):
    assert tuples(axis_bound(meta)) == [(300.0,)]
    assert tuples(axis_bound(deployments(spark, ("a", 300.5, None, True)), 50)) == [(350.0,)]
    assert tuples(axis_bound(deployments(spark, ("a", None, None, True)))) == [(None,)]


def test_profile_covers_every_known_depth(spark, folder):
    from faunatally.catalog.binding import tables

    meta = deploy_meta(tables(spark, folder).clean)
    known = meta.where("depth_m IS NOT NULL").count()
    for closed in ("left", "right"):
        assert depth_profile(meta, closed=closed).agg({"n_deployments": "sum"}).first()[0] == known
    assert as_set(depth_profile(meta).select("effort_status").distinct()) == {(FULL_EFFORT,), (PARTIAL_EFFORT,)}
