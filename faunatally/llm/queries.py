"""The queries of this subpackage: each operator with production parameters over its whole table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunatally.llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    html_extract,
    jaccard_join,
    line_dedup,
    merkle,
    mixing,
    spelling,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
)
from faunatally.llm.oracles import ORACLES
from faunatally.session import use_checkpoint_dir

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file: in $TOKENIZERS_DIR, or in the package that holds them."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch_folder(spark: SparkSession) -> str:
    """The folder that all executors share."""
    use_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], given.schema)
    return chat_format.read_back(chat_format.format_segments(given.unionByName(added)))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, _table(spark, folder, "benchmark"), "found").select("doc_id", "found.*")
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    lengths = F.transform("spans", lambda at, k: F.when(k % 2 == 1, at).otherwise(-at))
    hit = F.aggregate(lengths, F.lit(0), lambda total, x: total + x).cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents")).drop("spans")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"), vocabulary())


def op6_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    tokens = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(_table(spark, folder, "documents"), tokens, vocabulary())
    return token_files.read_documents(spark, tokens)


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.linked_vectors(_table(spark, folder, "embeddings"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    lexicon = toxicity.fit(docs, _table(spark, folder, "labels"))
    scored = docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.score(lexicon, "text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.variants(spelling.count_words(_table(spark, folder, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, folder, "documents").select(*fields)
    folded = F.translate("text", ascii_uppercase, ascii_lowercase)
    altered = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & (folded != F.col("text"))
    leaf = merkle.leaf_hash(*map(F.col, fields))
    # presented is NULL where the leaf is presented as it is
    presented = F.when(altered, merkle.leaf_hash(*map(F.col, fields[:-1]), folded))
    rows = docs.select("lang", "doc_id", leaf.alias("leaf"), F.unhex(presented).alias("presented"))
    found = merkle.manifest(rows, "lang", "doc_id", carry=["presented"])
    shown = F.coalesce(F.lower(F.hex("presented")), F.col("leaf"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), merkle.refold(shown).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(_table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_chat_format,
        op2_decontaminate,
        op3_jaccard_join,
        op4_suffix_dedup,
        op5_token_counts,
        op6_token_ids,
        op7_embedding_dedup,
        op8_line_dedup,
        op9_source_mix,
        op10_toxicity,
        op11_spelling_variants,
        op12_merkle_manifest,
        op13_html_extract,
    )
}
