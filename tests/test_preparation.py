import pytest

from faunatally.operators import keyed_join
from faunatally.operators.effort import deploy_meta
from faunatally.operators.keyed_join import repeated_keys, unique_keys
from faunatally.operators.preparation import (
    apply_exclusions,
    deployment_facts,
    drop_columns,
    effort_audit,
    exclusion_audit,
    flag_effort,
    mark_exclusions,
    merge_deployment_facts,
    merge_field_log,
)
from faunatally.plans.preparation import Fits, clean_deployments, clean_table
from faunatally.schema import ANNOTATIONS, FIELD_LOG, FREQ_EXCLUSIONS, MANUAL_EXCLUSIONS
from tests.rows import as_set, table, tuples

BOTH = pytest.mark.parametrize("small", [True, False])


@pytest.fixture(scope="module")
def annotations(spark):
    rows = [("d1", "A"), ("d1", "B"), ("d2", "A"), (None, "A"), ("d3", None), ("d9", "C")]
    return table(
        spark,
        ANNOTATIONS,
        [{"deployment": d, "scientificName": n, "row_key": i} for i, (d, n) in enumerate(rows)],
    )


@pytest.fixture(scope="module")
def field_log(spark):
    rows = [("d1", 10.0, "x", "Hard"), ("d2", None, "y", None), (None, 30.0, "z", "soft"), ("d3", 5.0, "w", "Hard")]
    return table(spark, FIELD_LOG, [dict(zip(FIELD_LOG.names, r)) for r in rows])


@pytest.fixture(scope="module")
def manual(spark):
    rows = [("d1", "B"), ("d3", None), (None, "A"), ("d1", "B"), ("d7", "A")]
    return table(spark, MANUAL_EXCLUSIONS, [dict(zip(MANUAL_EXCLUSIONS.names, r)) for r in rows])


@pytest.fixture(scope="module")
def partial(spark):
    return table(spark, FREQ_EXCLUSIONS, [{"deployment": d} for d in ("d2", None, "d2", "d8")])


@BOTH
def test_merge_joins_null_to_null_and_keeps_unlogged_rows(annotations, field_log, small):
    merged = merge_field_log(annotations, field_log, small=small)
    assert as_set(merged, "row_key", "depth_m", "location") == {
        (0, 10.0, "x"),
        (1, 10.0, "x"),
        (2, None, "y"),
        (3, 30.0, "z"),
        (4, 5.0, "w"),
        (5, None, None),
    }


def test_merge_drops_the_sheets_own_depth(spark, field_log):
    own = spark.createDataFrame([("d1", 99.0)], "deployment string, `depth(m)` double")
    assert merge_field_log(own, field_log).columns == ["deployment", "depth_m", "location", "substrate_type"]


def test_a_deployment_logged_twice_repeats_its_rows(spark, annotations, field_log):
    twice = field_log.union(table(spark, FIELD_LOG, [{"deployment": "d2", "depth_m": 7.0}]))
    assert merge_field_log(annotations, twice).count() == 7
    assert tuples(repeated_keys(twice, ["deployment"])) == [("d2", 2)]


@pytest.mark.parametrize("small", [True, False])
def test_a_repeated_log_key_stops_the_plan(annotations, field_log, small):
    twice = field_log.union(field_log.where("deployment is null"))
    assert merge_field_log(annotations, twice, small=small).count() == 7
    with pytest.raises(Exception, match="field log: 2 rows for deployment = NULL"):
        merge_field_log(annotations, twice, small=small, repeats="raise").collect()
    with pytest.raises(Exception, match="2 rows for deployment"):
        merge_deployment_facts(annotations, deployment_facts(twice, None, repeats="raise"), small=small).collect()
    once = merge_field_log(annotations, field_log, small=small, repeats="raise")
    assert as_set(once) == as_set(merge_field_log(annotations, field_log, small=small))
    with pytest.raises(ValueError, match="repeats must be"):
        merge_field_log(annotations, field_log, repeats="first")


def test_unique_keys_keeps_the_table_as_it_is(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.0, None)], "k int, v double, t string")
    assert unique_keys(df, ["k"], "t").columns == df.columns and as_set(unique_keys(df, ["k"], "t")) == as_set(df)
    assert as_set(unique_keys(df.select("k"), ["k"], "t")) == {(1,), (None,)}


def test_other_columns_of_the_annotations_stay(spark, field_log):
    own = spark.createDataFrame([("d1", "mine", 4, "x")], "deployment string, location string, n int, `Notes (free)` string")
    merged = merge_field_log(own, field_log)
    assert merged.columns == ["deployment", "location_annotated", "n", "Notes (free)", "depth_m", "location", "substrate_type"]
    assert tuples(merged) == [("d1", "mine", 4, "x", 10.0, "x", "Hard")]


@BOTH
def test_marked_rows_are_those_that_exclusion_removes(annotations, manual, small):
    marked = mark_exclusions(annotations, manual, small=small)
    assert as_set(marked.where("excluded"), "row_key") == {(1,), (3,), (4,)}
    assert mark_exclusions(annotations, None).where("excluded").count() == 0


def test_excluded_rows_are_counted_after_the_merge(annotations, field_log, manual):
    twice = field_log.union(field_log.where("deployment = 'd1'"))
    merged = merge_field_log(annotations, twice)
    assert tuples(exclusion_audit(merged, manual)) == [(8, 4, 4)]


@BOTH
def test_exclusions_match_null_keys(annotations, manual, small):
    assert as_set(apply_exclusions(annotations, manual, small=small), "row_key") == {(0,), (2,), (5,)}
    assert tuples(exclusion_audit(annotations, manual, small=small)) == [(6, 3, 3)]


def test_no_exclusion_list_removes_nothing(annotations):
    assert apply_exclusions(annotations, None).count() == 6
    assert tuples(exclusion_audit(annotations, None)) == [(6, 6, 0)]


@BOTH
def test_effort_flag_is_never_null(annotations, partial, small):
    flagged = flag_effort(annotations, partial, small=small)
    assert as_set(flagged, "row_key", "valid_for_freq") == {
        (0, True),
        (1, True),
        (2, False),
        (3, False),
        (4, True),
        (5, True),
    }
    assert tuples(effort_audit(partial)) == [(4,)]


def test_no_effort_list_flags_all_valid(spark, annotations):
    assert as_set(flag_effort(annotations, None), "valid_for_freq", "row_key") == {(True, i) for i in range(6)}
    assert tuples(effort_audit(None, spark)) == [(0,)]


@BOTH
def test_one_join_on_deployment_facts_equals_two(annotations, field_log, partial, small):
    at_once = merge_deployment_facts(annotations, deployment_facts(field_log, partial), small=small)
    stepwise = flag_effort(merge_field_log(annotations, field_log), partial)
    assert as_set(at_once) == as_set(stepwise.select(*at_once.columns))


@pytest.mark.parametrize("fits", [None, Fits(True, True, True), Fits(False, False, False), Fits(False, True, True)])
def test_clean_table(annotations, field_log, manual, partial, fits):
    clean = clean_table(annotations, field_log, manual, partial, fits)
    assert as_set(clean, "row_key", "depth_m", "valid_for_freq") == {
        (0, 10.0, True),
        (2, None, False),
        (5, None, True),
    }


def test_clean_table_without_lists(annotations, field_log):
    assert clean_table(annotations, field_log).where("valid_for_freq").count() == 6
    assert clean_table(annotations, field_log, fits=Fits(False, True, True)).where("valid_for_freq").count() == 6


def test_drop_columns_rejects_a_missing_name(annotations):
    assert "family" not in drop_columns(annotations, "family").columns
    with pytest.raises(ValueError, match="no such column: famly"):
        drop_columns(annotations, "famly")


def test_effort_audit_without_list_or_session(spark):
    assert [r.listed_rows for r in effort_audit(None).collect()] == [0]


def test_hot_deployments_are_counted_without_applying_the_exclusions(spark, monkeypatch):
    counted = []
    count = keyed_join.hot_keys
    monkeypatch.setattr(keyed_join, "hot_keys", lambda rows, keys, **k: counted.append((rows, keys)) or count(rows, keys, **k))
    rows = [{"deployment": d, "scientificName": n, "row_key": k} for k, (d, n) in enumerate([("a", "x"), ("a", "y"), (None, "x")])]
    log = table(spark, FIELD_LOG, [{"deployment": "a", "depth_m": 5.0}, {"depth_m": 7.0}])
    manual = table(spark, MANUAL_EXCLUSIONS, [{"deployment": "a", "scientificName": "y"}])
    freq = table(spark, FREQ_EXCLUSIONS, [{"deployment": "a"}])
    made = clean_table(table(spark, ANNOTATIONS, rows), log, manual, freq, Fits(False, False, False))
    assert as_set(made, "row_key", "depth_m", "valid_for_freq") == {(0, 5.0, False), (2, 7.0, True)}
    plans = [r._jdf.queryExecution().optimizedPlan().toString() for r, keys in counted if list(keys) == ["deployment"]]
    assert len(plans) == 1 and "LeftAnti" not in plans[0]


def test_deployments_of_the_clean_table(spark):
    seen = [("A", "x"), ("A", "y"), ("B", "x"), ("B", "x"), (None, "x"), (None, None), ("C", None), ("D", "z"), ("E", "z")]
    annotations = spark.createDataFrame(
        [(d, "p", "c", "o", "f", n, "Species", None, None, 1, k) for k, (d, n) in enumerate(seen)], ANNOTATIONS
    )
    log = spark.createDataFrame(
        [("A", 1.0, "l", "s"), ("A", 2.0, "l", "s"), ("B", 3.0, "l", "s"), (None, 4.0, "l", "s"), ("D", None, "l", None)], FIELD_LOG
    )
    manual = spark.createDataFrame([("B", "x"), ("C", None), (None, "x"), ("A", "x")], "deployment string, scientificName string")
    listed = spark.createDataFrame([("A",), (None,), ("Z",), ("A",)], "deployment string")
    for freq in (listed, None):
        for fits in (None, Fits(True, True, True), Fits(False, False, False)):
            want = deploy_meta(clean_table(annotations, log, manual, freq, fits)).collect()
            got = deploy_meta(clean_deployments(annotations, log, manual, freq, fits)).collect()
            assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) == 5
