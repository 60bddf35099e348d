"""Benchmark decontamination: normalised windows of test items in a broadcast hash set, scanned over training texts.

A window is ``length`` consecutive words of an item, or all its words if there are fewer. Words are runs of digits, ASCII
letters (folded to lower case) and characters beyond ASCII. The windows of a text are looked up by hash; each hit is verified
word by word. The table of windows is built from a block of items of bounded size. A benchmark beyond the bound is
taken in several blocks, one pass over the texts for each.

NULL and empty texts have no words and no hits; items without words have no windows. Items without an id count as hits
but cannot be listed; repeated items are listed once. All other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunatally.llm.wordhash import ALPHANUMERIC, windows, word_hashes, words_of
from faunatally.llm.stored import stored

WINDOW_WORDS = 10
BLOCK_BYTES = 16 * 1024 * 1024

FOUND = "struct<n_words: int, spans: array<int>, items: array<bigint>>"


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_words(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    _, starts, ends = words_of(text, ALPHANUMERIC)
    return [data[s:e].lower() for s, e in zip(starts.tolist(), ends.tolist())]


class WindowTable:
    """Windows of a block of items by hash, with what is needed to verify a hit."""

    def __init__(self, items: Sequence[tuple[int | None, str | None]], length: int):
        self.items = [(item, words) for item, text in items if (words := split_words(text or ""))]
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for place, (hashes, (_, words)) in enumerate(
            zip(word_hashes([b" ".join(w).decode("utf-8", "surrogatepass") for _, w in self.items], ALPHANUMERIC), self.items)
        ):
            size = min(length, len(words))
            for first, value in enumerate(windows(hashes, size).tolist()):
                found.setdefault(size, {}).setdefault(value, []).append((place, first))
        self.by_size = found
        self.filters = {}
        for size, values in found.items():
            bits = max(16, (16 * len(values) - 1).bit_length())
            marks = np.zeros(1 << bits, dtype=bool)
            marks[np.fromiter(values, np.uint64, len(values)) & np.uint64(len(marks) - 1)] = True
            self.filters[size] = marks

    def scan(self, text: str, hashes: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Word spans inside occurrences of windows, and the ids of their items."""
        spans, items = [], set()
        words = None
        for size, marks in self.filters.items():
            values = windows(hashes, size)
            for first in np.flatnonzero(marks[values & np.uint64(len(marks) - 1)]).tolist():
                places = self.by_size[size].get(int(values[first]))
                if places is None:
                    continue
                if words is None:
                    words = split_words(text)
                here = words[first : first + size]
                met = [self.items[place][0] for place, at in places if self.items[place][1][at : at + size] == here]
                if met:
                    spans.append((first, first + size))
                    items.update(item for item in met if item is not None)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted, joined spans as first, end, first, end, ..."""
    flat: list[int] = []
    for first, end in sorted(spans):
        if flat and first <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += (first, end)
    return flat


def _finder(table) -> Column:
    @F.pandas_udf(FOUND)
    def find(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        windows_ = table.value
        for texts, known_spans, known_items in parts:
            rows = []
            for text, hashes, old, ids in zip(texts, word_hashes(texts, ALPHANUMERIC), known_spans, known_items):
                spans, items = windows_.scan(text, hashes) if len(hashes) else ([], set())
                if old is not None and len(old):
                    spans += zip(old[::2].tolist(), old[1::2].tolist())
                if ids is not None:
                    items.update(ids.tolist())
                rows.append((len(hashes), merged(spans), sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return find


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str,
    *,
    length: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``name``: number of words, word spans of hits (first, end, ...), ids of the items.

    The size of the benchmark is measured first. Only one block of items is on the driver at a time.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    nothing = (F.lit(None).cast("array<int>"), F.lit(None).cast("array<bigint>"))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        table = spark.sparkContext.broadcast(WindowTable([tuple(r) for r in mine.collect()], length))
        before = nothing if block == 0 else (F.col(name)["spans"], F.col(name)["items"])
        docs = docs.withColumn(name, _finder(table)("text", *before))
        if blocks > 1:
            docs = stored(docs)
            table.destroy()
    return docs


@F.pandas_udf(T.StringType())
def without_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """The texts without the given word spans. What stands between kept words stays."""

    def cut(text: str, span) -> str:
        if span is None or not len(span):
            return text
        data = text.encode("utf-8", "surrogatepass")
        _, starts, ends = words_of(text, ALPHANUMERIC)
        kept, at = [], 0
        for first, end in zip(span[::2], span[1::2]):
            kept.append(data[at : starts[first]])
            at = int(ends[end - 1])
        return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")

    return pd.Series([cut(t, s) for t, s in zip(texts, spans)], dtype=object)


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", **settings) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit spans cut out of them (``remove="spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    name = free_name(docs, "benchmark_hits")
    found = find_benchmark(docs, benchmark, name, **settings)
    if remove == "documents":
        return found.where(F.size(F.col(name)["spans"]) == 0).select(*docs.columns)
    return found.withColumn("text", without_spans("text", F.col(name)["spans"])).select(*docs.columns)
