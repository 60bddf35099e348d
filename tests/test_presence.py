"""Presence sets give what the sightings give."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from faunatally.catalog import queries
from faunatally.operators import effort as eff
from faunatally.operators import inventory as inv
from faunatally.operators import occurrence as occ
from faunatally.operators import threshold as thr
from faunatally.operators import zones as zon
from faunatally.operators.presence import BITS, WORD, fold_units, number_of_units, presence_sets, unit_numbers
from faunatally.sources import taxon_keys
from tests.rows import clean, tuples


@pytest.fixture(scope="module")
def sightings(spark):
    draw = random.Random(2)
    depths = {f"d{k}": draw.choice([None, 100.0, 900.5, 1900.0, 1901.0, 2500.0]) for k in range(150)}
    rows = []
    for _ in range(1500):
        deployment = draw.choice([None, *depths])
        rows.append(
            {
                "deployment": deployment,
                "depth_m": depths.get(deployment, 50.0),
                "valid_for_freq": deployment not in ("d3", "d4") and draw.random() < 0.95,
                "phylum": draw.choice(["Chordata", "Mollusca", None]),
                "family": draw.choice(["F1", "F2", "", None]),
                "tax_order": draw.choice(["O1", "O2", None]),
                "scientificName": draw.choice([f"N{k}" for k in range(12)] + [None, ""]),
                "attracted": draw.choice(["Attracted", "Not attracted", None]),
                "individualCount": draw.choice([None, 1, 5, 9]),
            }
        )
    return clean(spark, *rows)


@pytest.fixture(scope="module")
def sets(sightings):
    return presence_sets(sightings, unit_numbers(sightings), threshold=thr.THRESHOLD)


def test_units_are_numbered_once(sightings):
    numbers = unit_numbers(sightings)
    known = sightings.where("deployment is not null").select("deployment").distinct().count()
    assert sorted(r.unit_no for r in numbers.collect()) == list(range(known))


def test_a_set_is_no_more_rows_than_its_pairs(sightings, sets):
    pairs = sightings.select("phylum", "family", "deployment").distinct()
    words = sets.groupBy("phylum", "family", WORD).agg(F.bit_or(BITS).alias(BITS))
    assert words.count() < pairs.count()
    assert words.agg(F.sum(F.bit_count(BITS))).first()[0] == pairs.count()


@pytest.mark.parametrize("count_null", [False, True])
def test_results_are_those_of_the_sightings(sightings, sets, count_null):
    meta = eff.deploy_meta(sightings)
    effort = eff.valid_effort(meta)
    zones = zon.zone_effort(meta)

    def results(df):
        zoned = zon.with_zone(df, zones, "Chordata")
        return {
            "families": occ.family_frequency(df, "Chordata", effort, count_null=count_null),
            "orders": occ.order_frequency(df, "Chordata", effort, count_null=count_null),
            "attracted": occ.attracted_metrics(df, effort, count_null=count_null),
            "ranges": occ.depth_ranges(df),
            "top": occ.top_max_n(df),
            "zone taxa": zon.zone_taxa(zoned, count_null=count_null),
            "zone groups": zon.zone_groups(zoned, count_null=count_null),
            "beyond": thr.taxa_beyond(df),
            "overlap": thr.threshold_overlap(df, count_null=count_null),
            "given names": thr.threshold_overlap(df, thr.taxa_beyond(df), count_null=count_null),
        }

    plain, merged = results(sightings), results(sets)
    for name in plain:
        assert plain[name].dtypes == merged[name].dtypes, name
        got, want = (sorted(map(str, tuples(r[name]))) for r in (merged, plain))
        assert got == want != [], name


def test_fold_of_sides(spark):
    df = spark.createDataFrame(
        [("a", "u1", 1), ("a", "u1", 9), ("a", None, 9), ("b", "u2", 1), ("b", None, 1), ("c", "u1", None)], "g string, u string, x int"
    )
    got = fold_units(df, ["g"], "u", {"high": F.col("x") > 5}, {"top": ("max", F.col("x"))})
    rows = got.select("g", number_of_units("high", False), number_of_units("high", True), "top").collect()
    assert sorted(map(tuple, rows)) == [("a", 1, 2, 9), ("b", 0, 0, 1), ("c", 0, 0, None)]


def test_inventory_makes_its_sets_once(spark, sightings, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "presence_sets", lambda *a, **k: made.append(1) or presence_sets(*a, **k))
    keys = taxon_keys(spark, {"phylum": ("Mollusca", "Chordata"), "class": (), "tax_order": ("O2",), "family": ("F2",)})
    t = SimpleNamespace(clean=sightings, keys=keys)
    got = tuples(queries.QUERIES["inventory_from_sets"](t))
    effort = eff.valid_effort(eff.deploy_meta(sightings))
    plain = inv.taxon_inventory(
        occ.depth_ranges(sightings), occ.attracted_metrics(sightings, effort), inv.tentative_ids(sightings), keys
    )
    assert made == [1]
    assert sorted(map(repr, got)) == sorted(map(repr, tuples(plain))) != []
