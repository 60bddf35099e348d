"""Joins and group sizes with hot keys, forced by low limits."""

import pytest
from pyspark.sql import functions as F

from faunatally.operators import keyed_join
from faunatally.operators.keyed_join import (
    fits_broadcast,
    hot_keys,
    measured_bytes,
    split_join,
    with_group_size,
)
from tests.rows import as_set, tuples

LOW = {"rows_per_piece": 10, "max_hot_keys": 50}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 600 rows under one key, a sixth under NULL, the others one to three to a key."""
    key = F.when(F.col("id") < 200, "hot").when(F.col("id") >= 300, F.concat(F.lit("k"), F.col("id") % 151))
    return spark.range(600).repartition(7).select(key.alias("k"), F.col("id").alias("row_key"))


@pytest.fixture(scope="module")
def facts(spark):
    rows = [("hot", 1), ("hot", 2), (None, 3), *[(f"k{i}", i) for i in range(0, 151, 2)], ("unused", 9)]
    return spark.createDataFrame(rows, "k string, v int")


def test_hot_keys_are_bounded_and_complete(skewed):
    hot = dict(tuples(hot_keys(skewed, ["k"], **LOW)))
    assert hot == {"hot": 17, None: 9}
    assert dict(tuples(hot_keys(skewed, ["k"]))) == {}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(skewed, facts, how):
    hot = hot_keys(skewed, ["k"], **LOW)
    split = split_join(skewed, facts, ["k"], how, spread_by=["row_key"], hot=hot)
    other = facts.withColumnRenamed("k", "k2")
    plain = skewed.join(other, F.col("k").eqNullSafe(F.col("k2")), how).drop("k2")
    assert split.columns == plain.columns
    assert sorted(map(repr, tuples(split))) == sorted(map(repr, tuples(plain)))


def test_hot_keys_that_share_a_bucket(skewed, monkeypatch):
    monkeypatch.setattr(keyed_join, "HASH_BUCKETS", 2)
    assert dict(tuples(hot_keys(skewed, ["k"], **LOW))) == {"hot": 17, None: 9}


def test_keys_are_counted_in_full_buckets_only(spark, capsys):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    hot = hot_keys(rows, ["k"], rows_per_piece=20, max_hot_keys=150)
    assert tuples(hot) == []
    hot.explain()
    assert "LeftSemi" in capsys.readouterr().out


def test_split_join_spreads_a_hot_key(spark, skewed, facts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        hot = hot_keys(skewed, ["k"], **LOW)
        joined = split_join(skewed, facts, ["k"], "left_semi", spread_by=["row_key"], hot=hot)
        parts = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count()
        largest = max(n for _, n in tuples(parts))
        assert parts.count() > 1
        assert largest < 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_exact_copies_are_spread_by_partition(spark, facts):
    copies = spark.range(400).repartition(8).select(F.lit("hot").alias("k"))
    hot = hot_keys(copies, ["k"], rows_per_piece=10, max_hot_keys=40)
    assert split_join(copies, facts, ["k"], "inner", hot=hot).count() == 800


@pytest.mark.parametrize("limits", [{}, LOW])
def test_group_size(skewed, limits):
    sized = with_group_size(skewed, ["k"], "n", spread_by=["row_key"], **limits)
    want = {repr(k): n for k, n in tuples(skewed.groupBy("k").count())}
    got = as_set(sized, "k", "row_key", "n")
    assert len(got) == 600
    assert all(n == want[repr(k)] for k, _, n in got)


def test_measured_bytes(spark, facts):
    text = spark.createDataFrame([("abcd", 1), (None, 2)], "s string, n int")
    assert measured_bytes(text) == 4 + 0 + 2 * 8 + 2 * 16
    assert measured_bytes(text.where("n > 5")) == 0
    assert fits_broadcast(text, 52) and not fits_broadcast(text, 51)
    nested = text.select(F.array("n").alias("a"))
    assert measured_bytes(nested) is None and not fits_broadcast(nested)
