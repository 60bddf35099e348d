"""Toxicity by a weighted lexicon that an Aho-Corasick automaton finds in folded text.

Folding undoes disguises before anything is matched: compatibility forms, look-alike letters of other scripts, digits and
signs that stand for letters, and invisible characters. The lexicon holds whole words and beginnings of words with their
log-odds; it is learnt from labelled rows, as are exception phrases, two-word phrases in which a listed word is mostly
harmless. A text's summed weight, plain and divided by its length, goes through a fitted logistic curve.

NULL and empty texts score like any text without listed words. Without labelled rows of both classes the lexicon is
empty and every score is 0. Repeated labels of a document count once, the higher one. NULL ids have no label.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.llm.stored import stored

# Letters of other scripts, digits and signs that look like a Latin letter.
LOOK_ALIKES = {
    "a": "аαɑ4@",
    "b": "вβ8",
    "c": "сϲ",
    "d": "ԁ",
    "e": "еєε3",
    "g": "ɡ9",
    "h": "һн",
    "i": "іιɩ1!|lӏ",
    "j": "јϳ",
    "k": "кκ",
    "m": "м",
    "n": "ո",
    "o": "оοσ0",
    "p": "рρ",
    "q": "ԛ",
    "s": "ѕ5$",
    "t": "тτ7",
    "u": "υս",
    "v": "νѵ",
    "w": "ԝω",
    "x": "хχ",
    "y": "уγү",
    "z": "ʐ2",
}
INVISIBLE = "­​‌‍‎‏⁠﻿"

_FOLD = {ord(sign): letter for letter, signs in LOOK_ALIKES.items() for sign in signs}
_FOLD |= {code: " " for code in range(128) if not chr(code).isalpha() and code not in _FOLD}
_FOLD |= dict.fromkeys(map(ord, INVISIBLE))
_BLANKS = re.compile(r"\s+")


def fold(text: str | None) -> str:
    """The text as the lexicon sees it: folded words, each with one space before and after it."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    words = _BLANKS.split(text.translate(_FOLD).strip())
    return f" {' '.join(words)} " if words[0] else " "


@dataclass
class Lexicon:
    """Terms are folded text with spaces at word edges: `` word `` is a whole word, `` beg`` the beginning of one."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] | None = None
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(first, end, weight) of the heaviest term at each place, without those inside an exception phrase."""
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                automaton.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                automaton.add_word(phrase, (len(phrase), None))
            automaton.make_automaton()
            self._automaton = automaton
        if not self.terms:
            return []
        found: dict[int, tuple[int, float]] = {}
        excepted: list[tuple[int, int]] = []
        for last, (length, weight) in self._automaton.iter(folded):
            first = last - length + 1
            if weight is None:
                excepted.append((first, last + 1))
            elif weight > found.get(first, (0, 0.0))[1]:
                found[first] = (last + 1, weight)
        # an exception cancels the hits that lie wholly inside it: of those that begin no later, the farthest end decides
        excepted.sort()
        kept, reach, at = [], 0, 0
        for first, (end, weight) in sorted(found.items()):
            while at < len(excepted) and excepted[at][0] <= first:
                reach = max(reach, excepted[at][1])
                at += 1
            if reach < end:
                kept.append((first, end, weight))
        return kept

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = sum(weight for _, _, weight in self.hits(folded))
        return math.log1p(total), math.log1p(100.0 * total / max(1, folded.count(" ") - 1))

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        bias, plain, dense = self.curve
        x, y = self.features(text)
        return 1.0 / (1.0 + math.exp(-min(max(bias + plain * x + dense * y, -50.0), 50.0)))


def score(lexicon: Lexicon, text: Column | str) -> Column:
    """Score from 0 to 1 of a text column."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([lexicon.score(t) for t in part], dtype="float64")

    return scored(text)


def held_out(doc_id: Column | str) -> Column:
    """True for the fifth of the ids that learning never sees."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _candidates(folded: str, lengths: range) -> set[str]:
    """Whole words and beginnings of words, once each."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in lengths if len(w) > n}


def _phrases(folded: str, lexicon: Lexicon) -> set[str]:
    """Two-word phrases around each hit."""
    out = set()
    for first, end, _ in lexicon.hits(folded):
        stop = folded.index(" ", max(end - 1, first + 1))
        before = folded.rfind(" ", 0, first) if first else -1
        after = folded.find(" ", stop + 1)
        if before >= 0:
            out.add(folded[before : stop + 1])
        if after >= 0:
            out.add(folded[first : after + 1])
    return out


def _counted(sample: DataFrame, terms) -> DataFrame:
    """(term, toxic, clean): in how many documents of either class each term occurs, partly summed in the map tasks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            by_class = (Counter(), Counter())
            for text, toxic in zip(batch["text"], batch["toxic"]):
                by_class[int(toxic)].update(terms(fold(text)))
            seen = list(by_class[0] | by_class[1])
            if not seen:
                continue
            yield pd.DataFrame(
                {"term": seen, "toxic": [by_class[1][t] for t in seen], "clean": [by_class[0][t] for t in seen]}
            )

    parts = sample.select("text", "toxic").mapInPandas(count, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(toxic: int, clean: int) -> Column:
    rate = (F.col("toxic") + 0.5) / (toxic + 1.0)
    return F.log(rate / ((F.col("clean") + 0.5) / (clean + 1.0)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton's method for two features and a bias."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_toxic: int = 10_000,
    max_clean: int = 20_000,
    max_terms: int = 2_000,
    min_documents: int = 5,
    min_share: float = 0.005,
    min_log_odds: float = 3.0,
    beginnings: range = range(4, 9),
) -> Lexicon:
    """Learn a lexicon from labelled documents that are not held out.

    It is fitted on a bounded sample, ``max_toxic`` and ``max_clean`` labelled ids in hash order, so the driver sees at
    most ``max_terms`` terms and two features of each sampled row. Two thirds of the sample give terms and exception
    phrases, the rest fit the curve. Labels of one class, or without a term that tells them apart, give a lexicon that
    scores every text 0. A term occurs in ``min_documents`` toxic documents and in ``min_share`` of them.
    """
    marked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("toxic"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    chosen = (
        marked.where("toxic = 1").orderBy("place", "doc_id").limit(max_toxic)
        .union(marked.where("toxic = 0").orderBy("place", "doc_id").limit(max_clean))
    )
    # at most max_toxic + max_clean rows of three numbers
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id"))
    learn, tune = sample.where("pmod(place, 3) < 2"), sample.where("pmod(place, 3) = 2")
    sizes = dict(learn.groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon()
    odds = _log_odds(sizes[1], sizes[0])
    frequent = _counted(learn, lambda folded: _candidates(folded, beginnings)).where(
        (F.col("toxic") >= max(min_documents, min_share * sizes[1])) & (odds >= min_log_odds)
    )
    best = frequent.orderBy((F.col("toxic") * odds).desc(), F.length("term"), "term").limit(max_terms)
    lexicon = Lexicon({row.term: row.weight for row in best.select("term", odds.alias("weight")).collect()})
    if not lexicon.terms:
        return Lexicon()
    harmless = _counted(learn, lambda folded: _phrases(folded, lexicon)).where(
        (F.col("clean") >= min_documents) & (odds <= -1.0)
    )
    lexicon.exceptions = tuple(
        row.term for row in harmless.orderBy(F.col("clean").desc(), "term").limit(max_terms).collect()
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [lexicon.features(t) for t in batch["text"]]
            yield pd.DataFrame({"x": [p[0] for p in pairs], "y": [p[1] for p in pairs], "toxic": batch["toxic"]})

    seen = tune.select("text", "toxic").mapInPandas(measured, "x double, y double, toxic int").toPandas()
    if seen["toxic"].nunique() < 2:
        seen = learn.select("text", "toxic").mapInPandas(measured, "x double, y double, toxic int").toPandas()
    lexicon.curve = _logistic(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy())
    return lexicon
