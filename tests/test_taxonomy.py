import pytest

from faunatally.operators.taxonomy import (
    class_richness,
    redundancy_audit,
    refine_taxa,
    richness_counts,
    true_richness,
)
from tests.rows import as_set, clean, tuples


def path(name, rank, phylum=None, klass=None, order=None, family=None, **more):
    return {
        "scientificName": name,
        "taxonRank": rank,
        "phylum": phylum,
        "class": klass,
        "tax_order": order,
        "family": family,
        **more,
    }


@pytest.fixture(scope="module")
def observations(spark):
    arthropod = ("Arthropoda", "Malacostraca", "Decapoda", "Pandalidae")
    return clean(
        spark,
        path("Heterocarpus", "Genus", *arthropod),
        path("Heterocarpus laevigatus", "Species", *arthropod, deployment="d1"),
        path("Heterocarpus laevigatus", "Species", *arthropod, deployment="d2"),
        path("Plesionika", "genus", *arthropod),
        path("Pandalidae", "FAMILY", *arthropod),
        path("Decapoda", "Order", *arthropod[:3], ""),
        path("Cnidaria", "Phylum", "Cnidaria"),
        path("Scyphozoa", "Class", "Cnidaria", "Scyphozoa"),
        path("Chordata", "Phylum", "Chordata"),
        path("Something odd", None),
    )


def test_redundant_paths(observations):
    assert as_set(redundancy_audit(refine_taxa(observations))) == {
        ("Heterocarpus", "Pandalidae", "Genus"),
        ("Pandalidae", "Pandalidae", "FAMILY"),
        ("Decapoda", "", "Order"),
        ("Cnidaria", "", "Phylum"),
    }


def test_lone_higher_taxa_and_species_are_kept(observations):
    kept = true_richness(refine_taxa(observations))
    assert as_set(kept, "scientificName") == {
        ("Heterocarpus laevigatus",),
        ("Plesionika",),
        ("Scyphozoa",),
        ("Chordata",),
        ("Something odd",),
    }


def test_blank_ranks_are_one_group_across_phyla(observations):
    sizes = dict(tuples(refine_taxa(observations), "scientificName", "n_class"))
    assert sizes["Cnidaria"] == sizes["Chordata"] == sizes["Something odd"] == 3
    refined = refine_taxa(observations)
    assert as_set(refined.where("scientificName = 'Decapoda'"), "n_family", "n_order", "n_genus") == {(5, 5, 1)}


def test_each_group_is_counted_on_its_own_key(observations):
    row = refine_taxa(observations).where("scientificName = 'Heterocarpus'").first()
    assert (row.n_phylum, row.n_class, row.n_order, row.n_family, row.n_genus) == (5, 5, 5, 4, 2)
    assert (row.first_word, row.rank_clean) == ("Heterocarpus", "genus")


def test_a_class_record_with_a_blank_class_is_redundant_beside_other_blanks(spark):
    rows = clean(spark, path("Vermes", "Class", "A"), path("Aus", "Phylum", "B"))
    assert as_set(redundancy_audit(refine_taxa(rows)), "scientificName") == {("Vermes",)}


def test_null_and_blank_are_two_paths_unless_normalised_first(spark):
    rows = clean(
        spark, path("Aus", "Order", "P", "C", "Aus", None), path("Aus", "Order", "P", "C", "Aus", "")
    )
    assert tuples(refine_taxa(rows), "family", "n_order", "is_redundant") == [("", 2, True)] * 2
    assert tuples(refine_taxa(rows, normalise_first=True), "family", "n_order", "is_redundant") == [("", 1, False)]


def test_names_without_a_first_word_share_a_group(spark):
    rows = clean(spark, path(" aus", "Genus", "P"), path(" bus", "Species", "P"), path("cus", "Genus", "P"))
    refined = refine_taxa(rows)
    assert as_set(refined, "scientificName", "first_word", "n_genus") == {
        (" aus", None, 2),
        (" bus", None, 2),
        ("cus", "cus", 1),
    }


def test_richness_counts_unknown_phylum_as_other(observations):
    assert tuples(richness_counts(refine_taxa(observations), "Chordata")) == [(5, 1, 4)]


def test_class_richness(observations):
    refined = refine_taxa(observations)
    assert tuples(class_richness(refined, ["Malacostraca", "Scyphozoa"])) == [(3,)]
    assert tuples(class_richness(refined, ["Holocephali"])) == [(0,)]


def test_result_does_not_depend_on_partitioning(observations):
    one, many = refine_taxa(observations.coalesce(1)), refine_taxa(observations.repartition(13))
    assert as_set(one) == as_set(many)
