import pytest

from faunatally.operators import inventory as inv
from faunatally.operators.occurrence import attracted_metrics, depth_ranges
from faunatally.sources import PHYLOGENETIC_KEYS, taxon_keys
from tests.rows import as_set, clean, tuples

LISTS = {"phylum": ["P2", "P1"], "class": ["K2", "K1"], "tax_order": ["R1"], "family": ["F2", "F1"]}


def taxon(name, phylum=None, klass=None, order=None, family=None, **more):
    return {
        "scientificName": name,
        "phylum": phylum,
        "class": klass,
        "tax_order": order,
        "family": family,
        **more,
    }


def test_tentative_ids_once_each_in_first_seen_order(spark):
    rows = clean(
        spark,
        *[taxon("N", family="Fam", tentativeId=t, row_key=k) for t, k in (("b", 3), ("a", 1), ("b", 0), ("a", 5))],
        taxon("N", family="Fam", tentativeId="c d", row_key=9),
        taxon("N", family="Fam", tentativeId="Fam", row_key=9),
        taxon("N", family=None, tentativeId="b", row_key=2),
        taxon("M", family="Fam", row_key=4),
    )
    assert as_set(inv.tentative_ids(rows), "scientificName", "family", "t_ids") == {
        ("N", "Fam", "*b* sp., *a* sp., *c d*, Fam"),
        ("N", None, "b"),
    }


def test_tentative_listing_and_pieces(spark):
    rows = clean(
        spark,
        *[taxon("N", family="Fam", tentativeId=t, row_key=k) for t, k in (("b", 3), ("a", 1), ("b", 0), ("a", 5), ("c", 1))],
        taxon("M", tentativeId="x y", row_key=4),
        taxon("M", row_key=4),
    )
    listing = inv.tentative_listing(rows)
    assert as_set(listing, "scientificName", "marked", "first_seen", "place") == {
        ("N", "*b* sp.", 0, 0),
        ("N", "*a* sp.", 1, 1),
        ("N", "*c* sp.", 1, 2),
        ("M", "*x y*", 4, 0),
    }
    assert as_set(inv.tentative_pieces(listing, size=2), "scientificName", "piece", "text") == {
        ("N", 0, "*b* sp., *a* sp."),
        ("N", 1, "*c* sp."),
        ("M", 0, "*x y*"),
    }


def test_a_million_identifications_of_one_taxon(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(1_000_000).select(
            *[F.lit(c).alias(c) for c in ("phylum", "class", "tax_order", "family", "scientificName")],
            F.concat(F.lit("T "), "id").alias("tentativeId"),
            (1_000_000 - F.col("id")).alias("row_key"),
        )
        listing = inv.tentative_listing(rows)
        pieces = inv.tentative_pieces(listing)
        spread = listing.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("count")).first()
        assert pieces.agg(F.count("piece"), F.max(F.length("text"))).first()[0] == 1000
        assert pieces.where("piece = 0").first()["text"].startswith("*T 999999*, *T 999998*")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # no task holds more than its share of the one taxon
    assert spread[1] >= 4 and spread[0] <= 400_000


def build(spark, *rows, exclude=(), keys=LISTS):
    df = clean(spark, *rows)
    effort = spark.sql("SELECT bigint(16) AS n")
    return inv.taxon_inventory(
        depth_ranges(df), attracted_metrics(df, effort), inv.tentative_ids(df), taxon_keys(spark, keys), exclude
    )


def test_strict_phylum_and_lenient_lower_levels(spark):
    rows = build(
        spark,
        taxon("a", None, None),
        taxon("b", "P9", "K1"),
        taxon("c", "P1", "K9"),
        taxon("d", "P1", "K1"),
        taxon("e", "P1", None),
        taxon("f", "P2", "K8"),
        taxon("g", "P1", "K8"),
        taxon("h", "P1", "K2"),
        taxon("i", "P1", "K2", "R9", "F1"),
        taxon("j", "P1", "K2", "R1", "F7"),
        taxon("k", "P1", "K2", "R1", "F2"),
        taxon("l", "P1", "K8", None, ""),
    )
    assert tuples(rows, "taxon", "phylum", "class") == [
        ("f", "P2", "K8"),
        ("k", "P1", "K2"),
        ("j", "P1", "K2"),
        ("i", "P1", "K2"),
        ("h", "P1", "K2"),
        ("d", "P1", "K1"),
        ("l", "P1", "K8"),
        ("g", "P1", "K8"),
        ("c", "P1", "K9"),
        ("e", "P1", ""),
        ("b", "", "K1"),
        ("a", "", ""),
    ]


def test_position_columns_carry_the_order(spark):
    rows = build(spark, taxon("a", "P1", "K1"), taxon("b", "P9", "K9"), taxon("c"))
    assert as_set(rows, "taxon", "phylum_pos", "class_pos") == {
        ("a", 2, 2),
        ("b", inv.MISSING, inv.UNLISTED),
        ("c", inv.MISSING, inv.MISSING),
    }


def test_inventory_text(spark):
    come = {"attracted": "Attracted", "deployment": "d1", "individualCount": 4, "depth_m": 10.0}
    rows = build(
        spark,
        taxon("Aus bus", "P1", "K1", "R1", "F1", tentativeId="Aus cus", **come),
        taxon("Aus", "P1", "K1", "R1", "F1", depth_m=2.5),
        taxon("F1", "P1", "K1", "R1", "F1"),
        taxon("R1", "P1", "K1", "R1", None, **come),
        taxon("R1", "P1", "K1", "R1", "", depth_m=1.0),
        taxon("Shown", "P1"),
        taxon("Hidden", "P1"),
        taxon(None, "P1"),
        exclude=["Hidden"],
    )
    shown = inv.labelled_inventory(rows)
    assert shown.columns == list(inv.INVENTORY_LABELS.values())
    assert as_set(shown.drop("Phylum", "Class", "Order")) == {
        ("F1", "*Aus bus*<br>(Tentative: *Aus cus*)", "10", "6", "4"),
        ("F1", "*Aus* sp.", "2.5", "", ""),
        ("F1", "F1", "", "", ""),
        ("", "R1", "10", "6", "4"),
        ("", "R1", "1", "", ""),
        ("", "Shown", "", "", ""),
        ("", "", "", "", ""),
    }


def test_positions_without_broadcast(spark, monkeypatch):
    rows = [taxon("a", "P1", "K1"), taxon("b", "P9", None), taxon("c", None, "K9")]
    want = as_set(build(spark, *rows))
    monkeypatch.setattr(inv, "fits_broadcast", lambda keys: False)
    assert as_set(build(spark, *rows)) == want


def test_fixed_key_lists(spark):
    assert {level: len(names) for level, names in PHYLOGENETIC_KEYS.items()} == {
        "phylum": 12,
        "class": 21,
        "tax_order": 35,
        "family": 52,
    }
    keys = taxon_keys(spark)
    assert as_set(keys.where("ordinal = 1"), "level", "name") == {
        ("phylum", "Foraminifera"),
        ("class", "Hexactinellida"),
        ("tax_order", "Actiniaria"),
        ("family", "Stylasteridae"),
    }
    assert keys.count() == keys.select("level", "name").distinct().count() == 120


@pytest.mark.parametrize("parts", [1, 13])
def test_order_of_tied_row_keys_does_not_depend_on_partitioning(spark, parts):
    rows = clean(spark, *[taxon("N", tentativeId=t, row_key=1) for t in ("z", "y", "x")]).repartition(parts)
    assert tuples(inv.tentative_ids(rows), "t_ids") == [("x, y, z",)]
