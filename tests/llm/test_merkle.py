"""The Merkle manifest against a plain version, with NULLs, repeats, many groups and trees of several depths."""

import random

import pytest
from tests.llm import brute

from faunatally.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos long, n long, hash string, run string"


def found(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 1, 2, "h", "r") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_merkle_manifest(spark, str(tmp_path))
    assert out.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


def rows_of(sizes, seed=1):
    draw = random.Random(seed)
    texts = [None, "", "Abc", "abc", "ÄÖ é", "x" * 3000, "Long TEXT " * 200]
    ids = iter(draw.sample(range(10_000), sum(sizes.values())))
    return [(next(ids), draw.choice(texts), lang, draw.choice([None, "src"]), draw.choice([None, 7])) for lang, k in sizes.items() for _ in range(k)]


@pytest.mark.parametrize(
    "sizes",
    [{"en": 600, "de": 64, "fr": 65, None: 9, "": 8, "Zz": 1, "é": 2}, {f"l{k}": 1 + k % 4 for k in range(70)}, {"en": 1}, {"en": 73}],
)
def test_manifest(spark, tmp_path, sizes):
    rows = rows_of(sizes)
    assert found(spark, rows, tmp_path) == sorted(brute.merkle_rows([(r[0], r[3], r[2], r[4], r[1]) for r in rows]), key=str)


def test_repeated_rows_null_ids_and_ties(spark, tmp_path):
    rows = rows_of({"en": 20, None: 3})
    rows += [rows[0], rows[0], (None, "A", "en", None, None), (None, None, "en", "s", 1), (rows[1][0], "other", "en", "s", 2)]
    assert found(spark, rows, tmp_path) == sorted(brute.merkle_rows([(r[0], r[3], r[2], r[4], r[1]) for r in rows]), key=str)


def test_no_rows(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_ancestors_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    rows = rows_of({"en": 520, "de": 70})
    assert found(spark, rows, tmp_path) == sorted(brute.merkle_rows([(r[0], r[3], r[2], r[4], r[1]) for r in rows]), key=str)


def test_a_changed_leaf_does_not_verify(spark, tmp_path):
    got = found(spark, rows_of({"en": 100}), tmp_path)
    assert {r[-1] for r in got} == {True, False}
    assert all((r[5] == r[3]) == r[-1] for r in got)
