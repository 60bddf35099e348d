"""Tables of the data model. ``order`` is called ``tax_order`` so that it never needs quoting in SQL."""

from __future__ import annotations

from pyspark.sql import types as T

RANKS = ("phylum", "class", "tax_order", "family")
TAXON = (*RANKS, "scientificName")

ANNOTATIONS = T.StructType(
    [
        T.StructField("deployment", T.StringType()),
        T.StructField("phylum", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("tax_order", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("scientificName", T.StringType()),
        T.StructField("taxonRank", T.StringType()),
        T.StructField("tentativeId", T.StringType()),
        T.StructField("attracted", T.StringType()),
        T.StructField("individualCount", T.IntegerType()),
        T.StructField("row_key", T.LongType()),
    ]
)

FIELD_LOG = T.StructType(
    [
        T.StructField("deployment", T.StringType()),
        T.StructField("depth_m", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("substrate_type", T.StringType()),
    ]
)

MANUAL_EXCLUSIONS = T.StructType(
    [T.StructField("deployment", T.StringType()), T.StructField("scientificName", T.StringType())]
)

FREQ_EXCLUSIONS = T.StructType([T.StructField("deployment", T.StringType())])

CLEAN = T.StructType(
    [
        *ANNOTATIONS.fields,
        *FIELD_LOG.fields[1:],
        T.StructField("valid_for_freq", T.BooleanType(), False),
    ]
)

TAXON_KEYS = T.StructType(
    [
        T.StructField("level", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
    ]
)

# Headings of the exported sheets and the model's names for them.
FIELD_LOG_HEADINGS = {
    "Deployment": "deployment",
    "Depth (m)": "depth_m",
    "Location": "location",
    "Substrate (Hard/Soft)": "substrate_type",
}
ANNOTATION_HEADINGS = {"order": "tax_order"}
ANNOTATION_DEPTH = "depth(m)"
