"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from faunatally.catalog.binding import Measured, Tables
from faunatally.catalog.oracles import ORACLES
from faunatally.catalog.queries import QUERIES
from faunatally.operators import keyed_join
from faunatally.plans.preparation import Fits
from tests.check_oracles import compare, connect

SQL = ORACLES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, folder, duck):
    assert compare(contract.queries()[name](spark, folder), duck, SQL[name]) is None


# The forms for side tables that do not fit a broadcast.
LARGE = Measured(False, Fits(False, False, False))


@pytest.fixture
def everything_is_large(spark, monkeypatch):
    """No broadcast but that of hot keys, and limits so low that many keys are hot."""
    monkeypatch.setitem(keyed_join.hot_keys.__kwdefaults__, "rows_per_piece", 20)
    monkeypatch.setitem(keyed_join.with_group_size.__kwdefaults__, "rows_per_piece", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name",
    [
        "merge_field_log",
        "apply_exclusions",
        "exclusion_audit",
        "flag_effort",
        "clean_table",
        "refine_taxa",
        "zone_groups_top10",
        "threshold_overlap",
    ],
)
def test_query_without_broadcast(name, spark, folder, duck, everything_is_large):
    assert compare(QUERIES[name](Tables(spark, folder, LARGE)), duck, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["family", "freq_occ"]
