"""Token ids in a binary file format: blocks of ids in byte or bit planes, each plane compressed by zstandard.

A data set is a folder written by Spark, so tasks that are run again leave no half-written parts. A row is a chunk of whole
documents in ascending id order:

- ``shard``, ``chunk``: its place; shards follow one another, chunks count from 0 in each;
- ``first``: ids before it in its shard; ``ids``: ids in it;
- ``doc_ids``, ``doc_tokens``: its documents and their lengths, end id included;
- ``blocks``: for each block of ``BLOCK`` ids (fewer in a chunk's last) its length and its planes.

Plane ``p`` of a block holds bit ``p`` (or byte ``p``) of every id, so the high planes, nearly all zero, shrink to nothing. The
columns other than ``blocks`` are the chunk index; reading them touches no ids.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faunatally.llm.stored import small_portions
from faunatally.llm.token_counts import byte_signs
from faunatally.llm.workers import giving_back

END_ID = 0
BLOCK = 1 << 16
CHUNK_IDS = 1 << 18
SHARD_BYTES = 64 * 1024 * 1024
CACHED_WORDS = 300_000

_COLUMNS = (
    "shard int",
    "chunk long",
    "first long",
    "ids long",
    "doc_ids array<long>",
    "doc_tokens array<long>",
    "blocks array<struct<ids: int, planes: array<binary>>>",
)
SCHEMA = ", ".join(_COLUMNS)
# A space between white space, or two spaces: the places where a word's ids depend on more than the word.
_SPACE_IN_BLANKS = re.compile(r"\s \s")


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """32 / ``bits`` planes of a block of ids below 2**32; ``bits`` is 1 or 8."""
    as_bytes = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        planes = np.ascontiguousarray(as_bytes.T)
    else:
        planes = np.packbits(np.unpackbits(as_bytes, axis=1, bitorder="little").T, axis=1, bitorder="little")
    pack = zstandard.ZstdCompressor(level=3).compress
    return [pack(plane.tobytes()) for plane in planes]


def from_planes(planes: list[bytes], length: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    raw = [np.frombuffer(unpack(plane), np.uint8) for plane in planes]
    if len(planes) == 4:
        as_bytes = np.ascontiguousarray(np.stack(raw, axis=1))
    else:
        bits = np.unpackbits(np.stack(raw), axis=1, count=length, bitorder="little")
        as_bytes = np.packbits(bits.T, axis=1, bitorder="little")
    return as_bytes.reshape(-1).view("<u4")


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer of the ``tokenizers`` library, each different word encoded once.

    Such a tokenizer takes one space into the word after it and never joins what stands before that space with what
    follows it, unless the space lies inside a longer run of white space; nor does it join letters with the punctuation
    after them. A text is therefore encoded word by word, and the words last seen are remembered, a bounded number of
    them. Texts with spaces inside white space, or with one of the tokenizer's own marks, are encoded in one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = byte_signs()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids of a text in one piece."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word and the space before it."""
        letters = word.rstrip(".,")
        if letters != word and letters[-1:].isalpha():
            return self._get(letters) + self._piece(word[len(letters) :])
        if "\n" in word:
            before, _, after = word.partition("\n")
            if before.strip() == before != "" and after.strip() == after != "":
                return self._get(before) + self._piece("\n") + self._piece(after)
        if word.isalpha():
            shown = f" {word}".encode().decode("latin-1").translate(self.signs)
            return np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
        return self.whole(" " + word)

    def _get(self, word: str) -> bytes:
        found = self.young.get(word) or self.old.get(word)
        if found is None:
            found = self.young[word] = self._word(word)
        return found

    def _piece(self, text: str) -> bytes:
        """Ids of a part of a text that has no space before it. Its key has one, which no word's key has."""
        found = self.young.get(" " + text) or self.old.get(" " + text)
        if found is None:
            found = self.young[" " + text] = self.whole(text)
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if "  " in text or text.endswith(" ") or _SPACE_IN_BLANKS.search(text) or any(m in text for m in self.marks):
            return np.frombuffer(self.whole(text), "<u4")
        first, *words = text.split(" ")
        for word in set(words).difference(self.young):
            self.young[word] = self.old.get(word) or self._word(word)
        ids = self._piece(first) + b"".join(map(self.young.__getitem__, words))
        if len(self.young) > CACHED_WORDS:
            self.young, self.old = {}, self.young
        return np.frombuffer(ids, "<u4")


def _encoded(path: str, end_id: int):
    """The ids of a batch of texts, each with its end id."""
    encode = Encoder(path)
    tail = np.array([end_id], dtype="<u4")
    return lambda texts: [np.concatenate([encode(text), tail]) for text in texts]


def _chunks(docs: DataFrame, vocabulary: str, end_id: int, bits: int) -> DataFrame:
    """Chunks of every partition of ``docs`` (doc_id, text), in the order of its rows."""

    def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoded(vocabulary, end_id)
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list = []

        def closed() -> pd.DataFrame:
            nonlocal chunk, first
            joined = np.concatenate(ids)
            parts = [joined[at : at + BLOCK] for at in range(0, len(joined), BLOCK)]
            blocks = [{"ids": len(part), "planes": to_planes(part, bits)} for part in parts]
            lengths = [len(x) for x in ids]
            row = (shard, chunk, first, len(joined), list(names), lengths, blocks)
            chunk, first = chunk + 1, first + len(joined)
            ids.clear()
            names.clear()
            return pd.DataFrame([row], columns=[c.split()[0] for c in _COLUMNS])

        held = 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                for name, found in zip(part["doc_id"].tolist(), encode(part["text"])):
                    names.append(None if pd.isna(name) else int(name))
                    ids.append(found)
                    held += len(found)
                    if held >= CHUNK_IDS:
                        yield closed()
                        held = 0
        if ids:
            yield closed()

    return docs.mapInPandas(giving_back(chunked), SCHEMA)


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, *, end_id: int = END_ID, plane_bits: int = 8, shards: int | None = None
) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the ids to ``folder`` in ascending order of doc_id.

    NULL texts are empty: a document of its end id. NULL ids come first; rows with one id stand in the order of a hash of
    their text. An empty table gives an empty data set. Other columns are not read. ``shards`` defaults to one for each
    64 MB of text. The range of a shard is cut by id and text hash, so an id with very many rows fills several.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-size // SHARD_BYTES), docs.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    with small_portions(docs.sparkSession):
        _chunks(ranged, vocabulary, end_id, plane_bits).write.parquet(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk index with ``start``, the ids of all chunks before it."""
    index = spark.read.schema(SCHEMA).parquet(folder).select("shard", "chunk", "first", "ids", "doc_ids", "doc_tokens")
    shards = index.groupBy("shard").agg(F.sum("ids").alias("total"))
    return index.join(_bases(shards), "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")


def _bases(shards: DataFrame) -> DataFrame:
    """(shard, base): ids before each shard; one row for each task that wrote, whatever the size of the texts."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the ids in the files: doc_id, start, n_tokens, ids_crc32."""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.concatenate([from_planes(list(b["planes"]), b["ids"]) for b in row.blocks])
                lengths = np.asarray(row.doc_tokens)
                ends = np.cumsum(lengths)
                cut = [ids[end - length : end] for length, end in zip(lengths, ends)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                        "shard": row.shard,
                        "within": row.first + ends - lengths,
                        "n_tokens": [len(x) for x in cut],
                        "ids_crc32": [zlib.crc32(x.tobytes()) for x in cut],
                    }
                )

    chunks = spark.read.schema(SCHEMA).parquet(folder)
    rows = chunks.select("shard", "first", "doc_ids", "doc_tokens", "blocks").mapInPandas(
        decoded, "doc_id long, shard int, within long, n_tokens long, ids_crc32 long"
    )
    bases = _bases(chunks.groupBy("shard").agg(F.sum("ids").alias("total")))
    return rows.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
