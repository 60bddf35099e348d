"""Ordered key lists for sorting taxa."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from faunatally.schema import TAXON_KEYS

# Phylogenetic order of the names at each level.
PHYLOGENETIC_KEYS = {
    "phylum": (
        "Foraminifera",
        "Microsporidia",
        "Porifera",
        "Cnidaria",
        "Ctenophora",
        "Nemertea",
        "Annelida",
        "Mollusca",
        "Arthropoda",
        "Echinodermata",
        "Chaetognatha",
        "Chordata",
    ),
    "class": (
        "Hexactinellida",
        "Hexacorallia",
        "Hydrozoa",
        "Octocorallia",
        "Scyphozoa",
        "Tentaculata",
        "Polychaeta",
        "Copepoda",
        "Malacostraca",
        "Cephalopoda",
        "Gastropoda",
        "Asteroidea",
        "Crinoidea",
        "Echinoidea",
        "Holothuroidea",
        "Ophiuroidea",
        "Appendicularia",
        "Myxini",
        "Holocephali",
        "Elasmobranchii",
        "Teleostei",
    ),
    "tax_order": (
        "Actiniaria",
        "Anthoathecata",
        "Narcomedusae",
        "Trachymedusae",
        "Siphonophora",
        "Siphonophorae",
        "Malacalcyonacea",
        "Scleralcyonacea",
        "Coronatae",
        "Cydippida",
        "Terebellida",
        "Amphipoda",
        "Decapoda",
        "Euphausiacea",
        "Mysida",
        "Nautilida",
        "Buccinida",
        "Paxillosida",
        "Valvatida",
        "Comatulida",
        "Isocrinida",
        "Aspidodiadematoida",
        "Cidaroida",
        "Diadematoida",
        "Echinothurioida",
        "Elasipodida",
        "Euryalida",
        "Chimaeriformes",
        "Aulopiformes",
        "Lampriformes",
        "Ophidiiformes",
        "Perciformes",
        "Siluriformes",
        "Stomiiformes",
        "Trachichthyiformes",
    ),
    "family": (
        "Stylasteridae",
        "Aeginidae",
        "Rhopalonematidae",
        "Acanthogorgiidae",
        "Balticinidae",
        "Primnoidae",
        "Periphyllidae",
        "Acrocirridae",
        "Eurytheneidae",
        "Acanthephyridae",
        "Aristeidae",
        "Calappidae",
        "Crangonidae",
        "Eumunididae",
        "Geryonidae",
        "Homolidae",
        "Lithodidae",
        "Lyreididae",
        "Munididae",
        "Munidopsidae",
        "Nematocarcinidae",
        "Nephropidae",
        "Oregoniidae",
        "Pandalidae",
        "Parapaguridae",
        "Platymaia",
        "Scyllaridae",
        "Sergestidae",
        "Solenoceridae",
        "Synaxidae",
        "Nautilus",
        "Buccinidae",
        "Astropectinidae",
        "Goniasteridae",
        "Isselicrinidae",
        "Aspidodiadematidae",
        "Cidaridae",
        "Diadematidae",
        "Echinothuriidae",
        "Elpidiidae",
        "Euryalidae",
        "Rhinochimaeridae",
        "Chimaeridae",
        "Aulopidae",
        "Lophotidae",
        "Ophidiidae",
        "Epigonidae",
        "Sternoptychidae",
        "Stomiidae",
        "Trachichthyidae",
        "Halosauridae",
        "Macrouridae",
    ),
}

# Names left out of the printed inventory.
INVENTORY_EXCLUSIONS = (
    "Animalia",
    "Myxinidae",
    "Chordata",
    "Actinopterygii",
    "Actinopteri",
    "Lutjanidae",
    "Epigonidae",
    "Arthropoda",
)


def taxon_keys(spark: SparkSession, lists: Mapping[str, Sequence[str]] = PHYLOGENETIC_KEYS) -> DataFrame:
    """The key lists as a table: level, name and 1-based place."""
    rows = [(level, name, place) for level, names in lists.items() for place, name in enumerate(names, start=1)]
    return spark.createDataFrame(rows, TAXON_KEYS)
