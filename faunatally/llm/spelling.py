"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One inserted or deleted code point changes a word's letter counts by 1 in one place, one replaced code point by 1 in two, so
words one edit apart have a squared distance of at most two and lie in blocks of the same or adjacent lengths. All squared
distances between two blocks come from one matrix product (|a|^2 + |b|^2 - 2ab). Pairs at most two apart are verified by
their code points.

Blocks by length alone would be multiplied with themselves at the square of the vocabulary. So the alphabet is dealt into
groups of about equal use, and a block has the same number of letters of each group. An edit moves a word to a block whose
numbers differ by one in one group, or by one in two groups; only such blocks meet, each pair of blocks once. The number of
groups grows with the vocabulary, which keeps a block's size about the same. A block above ``PIECE_WORDS`` is cut into pieces
that meet one another in different tasks, so no task holds a block whole. Within a task the same rule, with
twice the groups, says which parts of two blocks are multiplied at all.

Defined cases: NULL texts have no words; a NULL doc_id counts as empty text in the checksum; repeated rows count again;
texts of any length are read whole; a word of any length is a word. Ties between forms go by code-point order. Columns
other than doc_id and text are not read. An empty table has no words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.llm.stored import stored
from faunatally.operators.keyed_join import keyed_join

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ALTERED_EVERY = 31
PIECE_WORDS = 16_384
PIECE_CHARS = 4_000_000
#: Words a block may hold on average, lengths in common use, and the length the number of blocks is reckoned at.
BLOCK_WORDS, LENGTHS, USUAL_LENGTH = 8_192, 5, 10
PARTS = 2


def occurrences(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row ``word`` for each run of letters, lower-cased in A-Z, one in about 31 of them without one of its letters.

    A run loses the code point at ``h % length`` when ``h``, the checksum of ``<doc_id>:<run>``, is a multiple of 31.
    Runs too short to give a word of ``min_length`` code points are never made.
    """
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    summed = each.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    altered = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ALTERED_EVERY == 0, altered).otherwise(F.col("run"))
    return summed.select(word.alias("word")).where(F.length("word") >= min_length)


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough over all documents."""
    counted = occurrences(docs, min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def letter_groups(words: DataFrame, number: int) -> list[str]:
    """The letters in use, dealt into so many groups of about equal use. One row per letter reaches the driver."""
    used = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    groups, weights = [""] * number, [0] * number
    for row in sorted(used, key=lambda r: (-r["count"], r["letter"])):
        lightest = weights.index(min(weights))
        groups[lightest] += row["letter"]
        weights[lightest] += row["count"]
    return groups


def _number_of_groups(words: int) -> int:
    number = 1
    while math.comb(USUAL_LENGTH - 1 + number, number - 1) * LENGTHS * BLOCK_WORDS < words:
        number += 1
    return number


def _quoted(letters: str) -> str:
    """A group as the alphabet of ``translate``; a letter more keeps an empty group from meaning all letters."""
    return letters or "\0"


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def _blocks_met(counts: list[Column]) -> Column:
    """Keys of the blocks above a word's own: one letter more in a group, or one moved to a later group."""
    met = []
    for i in range(len(counts)):
        met.append(_key([*counts[:i], counts[i] + 1, *counts[i + 1 :]]))
        for j in range(i):
            moved = list(counts)
            moved[j], moved[i] = moved[j] - 1, moved[i] + 1
            met.append(F.when(counts[j] > 0, _key(moved)))
    return F.array_compact(F.array(*met))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words of ``words`` (word, n; stored, distinct) one edit apart, in both directions."""
    total = words.count()
    groups = letter_groups(words, _number_of_groups(total))
    names = [f"c{k}" for k in range(len(groups))]
    counts = [F.length("word") - F.length(F.translate("word", _quoted(g), "")) for g in groups]
    counted = words.select("word", "n", *[c.alias(name) for c, name in zip(counts, names)])
    numbers = list(map(F.col, names))
    keyed = counted.select("word", "n", _key(numbers).alias("own"), _blocks_met(numbers).alias("met"))
    pieces = F.greatest(
        F.ceil(F.count(F.lit(1)) / PIECE_WORDS), F.ceil(F.sum(F.length("word")) / PIECE_CHARS)
    )
    sizes = stored(keyed.groupBy("own").agg(pieces.cast("int").alias("pieces")).withColumnRenamed("own", "block"))
    sent = keyed.select("word", "n", "own", F.explode(F.concat(F.array("own"), "met")).alias("block"))
    # a block that holds no word needs no visitors
    dealt = keyed_join(sent, sizes, ["block"], "inner", spread_by=["word"])
    home = F.col("block") == F.col("own")
    own_piece = F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int")
    first = F.when(home, own_piece).otherwise(F.lit(0))
    placed = dealt.select(
        "word", "n", "block", F.explode(F.sequence(first, F.col("pieces") - 1)).alias("piece"), home.alias("home"), own_piece.alias("own_piece")
    ).select("word", "n", "block", "piece", (~(F.col("home") & (F.col("piece") == F.col("own_piece")))).alias("visits"))
    sorted_rows = placed.repartition("block", "piece").sortWithinPartitions("block", "piece", "visits")
    alphabet = np.array(sorted(ord(c) for g in groups for c in g), dtype=np.uint32)
    part_of = np.array([_part(chr(c), groups) for c in alphabet], dtype=np.int64)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, home_rows, rows, visiting = None, None, [], 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal home_rows, rows, visiting
            if not rows:
                return
            chunk = Words(pd.concat(rows, ignore_index=True), alphabet, part_of)
            rows, visiting = [], 0
            if home_rows is None:
                home_rows = chunk
            yield from _near(home_rows, chunk)

        for batch in batches:
            for name, group in batch.groupby(["block", "piece"], sort=False):
                if name != task:
                    yield from flush()
                    task, home_rows = name, None
                for visits, part in group.groupby("visits", sort=True):
                    if visits and home_rows is None:
                        yield from flush()
                        if home_rows is None:  # a piece no word was dealt to
                            home_rows = Words(part.iloc[:0], alphabet, part_of)
                    for at in range(0, len(part), PIECE_WORDS):
                        rows.append(part.iloc[at : at + PIECE_WORDS])
                        visiting += len(rows[-1])
                        if visits and visiting >= PIECE_WORDS:
                            yield from flush()
        yield from flush()

    return sorted_rows.mapInPandas(compare, "word string, near string, near_n long")


def _part(letter: str, groups: list[str]) -> int:
    """Which part of which group a letter belongs to: a group's letters are dealt in turn to its parts."""
    k = next(k for k, g in enumerate(groups) if letter in g)
    return k * PARTS + groups[k].index(letter) % PARTS


class Words:
    """Words of a block, sorted into parts with the same numbers of letters of each part of the alphabet."""

    def __init__(self, rows: pd.DataFrame, alphabet: np.ndarray, part_of: np.ndarray):
        words, n = rows["word"].to_numpy(dtype=object), rows["n"].to_numpy(dtype=np.int64)
        size = len(words)
        texts = np.array(list(words), dtype=np.str_) if size else np.zeros(0, dtype="U1")
        width = texts.dtype.itemsize // 4
        codes = np.ascontiguousarray(texts).view(np.uint32).reshape(size, width)
        lengths = (codes != 0).sum(1)
        place = np.minimum(np.searchsorted(alphabet, codes), len(alphabet) - 1)
        inside = codes != 0
        row = np.broadcast_to(np.arange(size)[:, None], codes.shape)
        # counts of up to 2,000 letters have squares that 32-bit floats hold exactly
        exact = np.float32 if width <= 2000 else np.float64
        cells = row[inside] * len(alphabet) + place[inside]
        counts = np.bincount(cells, minlength=size * len(alphabet)).reshape(size, len(alphabet)).astype(exact)
        parts = np.zeros((size, int(part_of.max(initial=0)) + 1), dtype=np.float64)
        for k, part in enumerate(part_of):
            parts[:, part] += counts[:, k]
        keys, belongs = np.unique(parts, axis=0, return_inverse=True)
        order = np.argsort(belongs.ravel(), kind="stable")
        self.words, self.n, self.lengths = words[order], n[order], lengths[order]
        self.codes, self.counts = codes[order], counts[order]
        self.squares = (self.counts.astype(np.float64) ** 2).sum(1).astype(exact)
        self.keys = keys
        self.bounds = np.searchsorted(belongs.ravel()[order], np.arange(len(keys) + 1))


def _distances(a: np.ndarray, a_squares: np.ndarray, b: np.ndarray, b_squares: np.ndarray) -> np.ndarray:
    return a_squares[:, None] + b_squares[None, :] - 2 * (a @ b.T)


def _near(home: Words, chunk: Words) -> Iterator[pd.DataFrame]:
    """Pairs one edit apart between a block and a chunk of words, or within the block when they are the same."""
    if not len(home.words) or not len(chunk.words):
        return
    same = home is chunk
    met = _distances(home.keys, (home.keys**2).sum(1), chunk.keys, (chunk.keys**2).sum(1)) <= 2
    left, right, waiting = [], [], 0
    for p, q in zip(*np.nonzero(met)):
        if same and q < p:
            continue
        a0, a1, b0, b1 = home.bounds[p], home.bounds[p + 1], chunk.bounds[q], chunk.bounds[q + 1]
        a, b = home.counts[a0:a1], chunk.counts[b0:b1]
        i, j = np.nonzero(_distances(a, home.squares[a0:a1], b, chunk.squares[b0:b1]) <= 2)
        if same and p == q:
            keep = i < j
            i, j = i[keep], j[keep]
        left.append(i + a0)
        right.append(j + b0)
        waiting += len(i)
        if waiting >= 200_000:
            yield from _verified(home, chunk, np.concatenate(left), np.concatenate(right))
            left, right, waiting = [], [], 0
    if waiting:
        yield from _verified(home, chunk, np.concatenate(left), np.concatenate(right))


def _verified(home: Words, chunk: Words, i: np.ndarray, j: np.ndarray) -> Iterator[pd.DataFrame]:
    step = max(1, 8_000_000 // max(home.codes.shape[1], chunk.codes.shape[1]))
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        one = one_edit(home.codes[x], home.lengths[x], chunk.codes[y], chunk.lengths[y])
        a, b = x[one], y[one]
        yield pd.DataFrame(
            {
                "word": np.concatenate([home.words[a], chunk.words[b]]),
                "near": np.concatenate([chunk.words[b], home.words[a]]),
                "near_n": np.concatenate([chunk.n[b], home.n[a]]),
            }
        )


def one_edit(a: np.ndarray, a_lengths: np.ndarray, b: np.ndarray, b_lengths: np.ndarray) -> np.ndarray:
    """Which rows of two code-point matrices (padded with 0) differ by exactly one inserted, deleted or replaced point."""
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    differs = a != b
    out = (a_lengths == b_lengths) & (differs.sum(1) == 1)
    before = np.cumsum(differs, axis=1) - differs == 0  # equal up to here
    for short, long, applies in ((a, b, b_lengths == a_lengths + 1), (b, a, a_lengths == b_lengths + 1)):
        rest = short[:, :-1] != long[:, 1:]
        after = np.cumsum(rest[:, ::-1], axis=1)[:, ::-1] == 0  # equal from here on, one place later in the longer word
        out |= applies & (before[:, :-1] & after).any(axis=1)
    return out


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words`` (word, n).

    ``form`` is the near word of largest ``n``, equal ones by code-point order, if it occurs ``ratio`` times as often;
    ``root`` is where following the forms ends. A form occurs ``ratio`` times as often as its word, so a chain is
    no longer than the logarithm of the largest ``n``, and pointers that double reach its end in the logarithm of that.
    """
    words = stored(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    often = (-F.col("best.less")) >= F.col("n") * ratio
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.word")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    largest = words.agg(F.max("n")).first()[0] or 1
    reach, longest = 1, math.log(largest, ratio) if ratio > 1 else 64
    while reach < longest:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
        reach *= 2
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
