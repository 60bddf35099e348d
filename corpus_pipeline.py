"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, source mix, token files.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it again for the next. All stages but the last return the columns of documents;
the last returns one row per document as read back from the token files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faunatally.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from faunatally.llm.queries import scratch_folder, vocabulary
from faunatally.llm.stored import stored

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, with a lexicon learnt from the labels of the documents at hand."""
    lexicon = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score(lexicon, "text") < TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mixture takes them, up to twice."""
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what is read back: doc_id, start, n_tokens, ids_crc32."""
    folder = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(docs, folder, vocabulary())
    return token_files.read_documents(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# The first stage is a trained model and the last a tokenizer; neither can be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return stored(STAGES[-1][1](spark, docs, sf_dir))
