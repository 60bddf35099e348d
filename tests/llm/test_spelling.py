"""Spelling variants against a test of every pair of words."""

import random

import numpy as np
import pytest
from tests.llm import brute

from faunatally.llm import spelling

DOCS = "doc_id long, text string, word string, n long, block string"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edited(word, draw):
    k = draw.randrange(len(word))
    return draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice("aeézÿ") + word[k:], word[:k] + draw.choice("bdfÀ") + word[k + 1 :]])


def texts(seed):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcdeéßxyz") for _ in range(draw.randint(7, 12))) for _ in range(25)]
    base += ["stressed", "desserts", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaaab"]
    pool = base * 12 + [edited(w, draw) for w in base for _ in range(6)] * 2
    for w in base[:8]:
        pool += [w] * 130 + [edited(edited(w, draw), draw)] * 2
    pool += ["chaining"] * 400 + ["chainin"] * 25 + ["chainix"] * 2
    draw.shuffle(pool)
    out = [draw.choice([" ", ", ", "-", "1"]).join(pool[k : k + 40]) for k in range(0, len(pool), 40)]
    out[3] = out[3].upper()
    # long ones: a word of many letters twice, and a text of over a megabyte
    return [*out, None, "", " \n", "short", "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5001, "stretched " * 120_000]


@pytest.mark.parametrize("piece, block", [(16_384, 8_192), (4, 1), (5, 8_192)])
def test_variants(spark, monkeypatch, piece, block):
    monkeypatch.setattr(spelling, "PIECE_WORDS", piece)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts(piece))]
    rows += [rows[1], rows[1], (rows[2][0], rows[4][1])]
    docs = spark.createDataFrame([(*r, "w", 1, "b") for r in rows], DOCS)
    got = spelling.variants(spelling.count_words(docs)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.spelling_variants(brute.spelling_words(rows)), key=str)
    assert any(r.root not in (r.word, r.form) for r in got) and any(r.n_near > 3 for r in got)


def test_no_words(spark):
    for rows in ([], [(1, None, "", 0, "")], [(1, "seventh eighths", "", 0, "")]):
        assert spelling.variants(spelling.count_words(spark.createDataFrame(rows, DOCS))).collect() == []


def test_one_edit_of_every_short_word():
    words = [a + b + c + d for a in ("", "a", "b") for b in ("", "a", "b") for c in ("a", "b") for d in ("", "a", "c")]
    words = sorted(set(words))
    codes = np.array(words).view(np.uint32).reshape(len(words), -1)
    lengths = (codes != 0).sum(1)
    for k, w in enumerate(words):
        same = np.full(len(words), k)
        got = spelling.one_edit(codes[same], lengths[same], codes, lengths)
        assert got.tolist() == [brute.one_edit(w, v) for v in words]


def test_blocks_that_meet_hold_every_edit(spark):
    """A word and any word one edit from it are in the same block, or one of the two visits the other's."""
    from pyspark.sql import functions as F

    draw = random.Random(7)
    pairs = [(w, edited(w, draw)) for w in ["".join(draw.choice("abcdefg") for _ in range(8)) for _ in range(200)]]
    groups = ["ab", "cdÀ", "e", "fgé", "zÿ", ""]
    counts = [F.length("w") - F.length(F.translate("w", g or "\0", "")) for g in groups]
    both = spark.createDataFrame([(k, w) for k, pair in enumerate(pairs) for w in pair], "k int, w string")
    rows = both.select("k", "w", spelling._key(counts).alias("own"), spelling._blocks_met(counts).alias("met")).collect()
    for a, b in zip(rows[::2], rows[1::2]):
        assert a.k == b.k and (a.own == b.own) + (a.own in b.met) + (b.own in a.met) == 1
