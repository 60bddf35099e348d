"""The given star-schema tables read as observation tables.

``lineitem`` rows are annotations, ``part`` the taxonomy and ``orders`` the deployments. The tables hold no NULLs and no
ties worth testing, so the binding derives them from attributes. ``oracles.PREFIX`` says the same in SQL. Every row of
the three tables takes part.
"""

from __future__ import annotations

import uuid
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faunatally.operators.keyed_join import fits_broadcast, keyed_join
from faunatally.plans.preparation import Fits, clean_deployments, clean_sightings, clean_table, marked_table, measure
from faunatally.schema import ANNOTATIONS
from faunatally.session import use_checkpoint_dir
from faunatally.sources import taxon_keys

# Names that play the report's parts.
PHYLUM = "P0"
RICHNESS_CLASSES = ("C0", "C12")
EXCLUDED_CLASSES = ("C0", "C24")
DISPLAY_EXCLUSIONS = ("C0", "O1", "F2")
KEY_LISTS = {
    "phylum": ("P3", "P1", "P0", "P2", "P5", "P4", "P7", "P6", "P9", "P8"),
    "class": ("C3", "C0", "C1"),
    "tax_order": ("O5", "O2", "O0"),
    "family": ("F9", "F3", "F0"),
}

# Columns that the annotation sheet has beside the model's, from lineitem.
OTHER_COLUMNS = {"observer": "l_suppkey", "Notes (free)": "l_linestatus", "location": "l_returnflag"}


def _unlabelled() -> Column:
    return (F.col("l_tax") == 0) & (F.col("l_discount") == 0)


class Measured(NamedTuple):
    """Which side tables were measured small enough to broadcast."""

    taxon: bool
    sides: Fits


class Tables:
    """Lazy observation tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str, measured: Measured | None = None):
        self.spark = spark
        self.folder = folder
        self._given = measured

    def _scan(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def measured(self) -> Measured:
        if self._given is not None:
            return self._given
        taxon = fits_broadcast(self.taxon)
        # the manual list is derived from the annotations, which need the taxon answer
        listed = self._manual_exclusions(taxon)
        return Measured(taxon, measure(self.field_log, listed, self.freq_exclusions))

    @property
    def fits(self) -> Fits:
        return self.measured.sides

    @cached_property
    def taxon(self) -> DataFrame:
        """What the taxonomy is derived from: per part its rank, 6 for rare species, and the second word of its name."""
        size = F.col("p_size")
        rank = F.when(size <= 2, 0).when(size <= 5, 1).when(size <= 9, 2).when(size <= 17, 3).when(size <= 27, 4)
        word = F.when(size.isNull() | (size > 27), F.split_part("p_name", F.lit(" "), F.lit(2)))
        return self._scan("part").select(
            "p_partkey", F.when(size > 45, 6).otherwise(rank.otherwise(5)).alias("part_rank"), word.alias("part_word")
        )

    @cached_property
    def lines(self) -> DataFrame:
        """The lines with the deployment and key of their annotation."""
        deployment = (
            F.when(_unlabelled(), F.lit(None))
            .when(F.col("l_discount") == 0.1, F.concat(F.lit("X"), "l_orderkey"))
            .otherwise(F.concat(F.lit("D"), "l_orderkey"))
        )
        return self._scan("lineitem").withColumns(
            {"row_key": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "deployment": deployment}
        )

    def _named(self, lines: DataFrame, taxon_fits: bool) -> DataFrame:
        """Lines with their taxonomy. The join moves keys and ranks, the names are made of them after it."""
        key, r = F.col("p_partkey"), F.col("part_rank")

        def name(letter: str, members: int):
            return F.concat(F.lit(letter), F.floor(key / members))

        phylum = F.concat(F.lit("P"), F.floor(key / 60) % 12)
        species = F.concat(name("G", 2), F.lit(" "), "part_word")
        found = keyed_join(
            lines.withColumnRenamed("l_partkey", "p_partkey"),
            self.taxon,
            ["p_partkey"],
            "left",
            small=taxon_fits,
            count_in=self._scan("lineitem").select(F.col("l_partkey").alias("p_partkey")),
        )
        return found.withColumns(
            {
                "phylum": F.when(r.isNotNull() & (key % 97 != 96), phylum),
                "class": F.when(r > 0, name("C", 60)),
                "tax_order": F.when(r > 1, name("O", 15)),
                "family": F.when(r > 2, name("F", 5)).when(r == 2, ""),
                "scientificName": F.when(r == 0, phylum)
                .when(r == 1, name("C", 60))
                .when(r == 2, name("O", 15))
                .when(r == 3, name("F", 5))
                .when(r == 4, name("G", 2))
                .when(r == 5, species)
                .when(r == 6, F.concat(species, F.lit(" s"), "l_suppkey")),
                "taxonRank": F.when(r == 0, "Phylum")
                .when(r == 1, "CLASS")
                .when(r == 2, "Order")
                .when(r == 3, "Family")
                .when(r == 4, "genus")
                .when(r > 4, "Species"),
            }
        )

    @cached_property
    def _annotations(self) -> DataFrame:
        tentative = F.when(
            F.col("l_linestatus") == "O",
            F.concat(F.split_part("scientificName", F.lit(" "), F.lit(1)), F.lit(" "), "l_linenumber"),
        ).otherwise(F.concat(F.lit("T"), "l_linenumber"))
        return self._named(self.lines, self.measured.taxon).withColumns(
            {
                "individualCount": F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int")),
                "attracted": F.when(F.col("l_returnflag") == "A", "Attracted").when(
                    F.col("l_returnflag") == "R", "Not attracted"
                ),
                "tentativeId": F.when(F.col("l_tax") == 0.08, tentative),
                **{name: F.col(column) for name, column in OTHER_COLUMNS.items()},
            }
        )

    @cached_property
    def annotations(self) -> DataFrame:
        return self._annotations.select(*ANNOTATIONS.names)

    @cached_property
    def annotations_all_columns(self) -> DataFrame:
        """The annotations with columns the model does not know, one of them under a name of the field log."""
        return self._annotations.select(*ANNOTATIONS.names, *OTHER_COLUMNS)

    @cached_property
    def repeated_log(self) -> DataFrame:
        """The field log with a second, deeper entry for some deployments."""
        again = self.field_log.where(F.col("location").isin("L3", "L4"))
        return self.field_log.unionAll(again.withColumn("depth_m", F.col("depth_m") + 100))

    @cached_property
    def field_log(self) -> DataFrame:
        key = F.col("o_orderkey")
        depth = F.floor(F.col("o_totalprice") / 200) + (key % 2).cast("double") / 2
        priority = F.col("o_orderpriority")
        return self._scan("orders").select(
            F.when(key != 0, F.concat(F.lit("D"), key)).alias("deployment"),
            F.when(F.col("o_custkey") % 20 != 0, depth).alias("depth_m"),
            F.concat(F.lit("L"), F.col("o_custkey") % 25).alias("location"),
            F.when(priority == "1-URGENT", "Hard")
            .when(priority == "2-HIGH", "soft")
            .when(priority == "3-MEDIUM", "Hard/Soft")
            .when(priority == "4-NOT SPECIFIED", "Hard")
            .alias("substrate_type"),
        )

    @cached_property
    def freq_exclusions(self) -> DataFrame:
        partial = (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM")
        return self._scan("orders").where(partial).select(F.concat(F.lit("D"), "o_orderkey").alias("deployment"))

    def _manual_exclusions(self, taxon_fits: bool) -> DataFrame:
        withdrawn = (F.col("l_linestatus") == "O") & (F.col("l_tax") == 0.07) & (F.col("l_linenumber") <= 2)
        listed = self.lines.where(withdrawn | (_unlabelled() & (F.col("l_linenumber") == 1)))
        return self._named(listed, taxon_fits).select("deployment", "scientificName")

    @cached_property
    def manual_exclusions(self) -> DataFrame:
        return self._manual_exclusions(self.measured.taxon)

    @cached_property
    def clean(self) -> DataFrame:
        """The preparation job's result: excluded, merged and flagged."""
        return self._clean(self.annotations)

    @cached_property
    def clean_deployments(self) -> DataFrame:
        """The clean table's deployments, without its rows."""
        lists = (self.field_log, self.manual_exclusions, self.freq_exclusions)
        return clean_deployments(self.annotations, *lists, self.fits)

    def sightings(self, numbers: DataFrame | None = None) -> DataFrame:
        """The clean table's sightings, with the numbers of their deployments where those come with the log."""
        lists = (self.field_log, self.manual_exclusions, self.freq_exclusions)
        return clean_sightings(self.annotations, *lists, self.fits, count_in=self.lines, numbers=numbers)

    @cached_property
    def clean_all_columns(self) -> DataFrame:
        return self._clean(self.annotations_all_columns)

    def _clean(self, annotations: DataFrame) -> DataFrame:
        lists = (self.field_log, self.manual_exclusions, self.freq_exclusions)
        return clean_table(annotations, *lists, self.fits, count_in=self.lines)

    def marked(self, field_log: DataFrame) -> DataFrame:
        """The preparation job's rows with the excluded ones marked."""
        lists = (field_log, self.manual_exclusions, self.freq_exclusions)
        return marked_table(self.annotations, *lists, self.fits, count_in=self.lines)

    def new_folder(self, name: str) -> str:
        """A folder of its own beside the checkpoints, for queries that write files and read them back."""
        use_checkpoint_dir(self.spark)
        return f"{self.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def keys(self) -> DataFrame:
        return taxon_keys(self.spark, KEY_LISTS)


# The lazy tables, and the measured sizes, of a data folder are kept for the queries of one application.
_tables: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = Tables(spark, folder)
    return _tables[key]
