import random

import pytest
from pyspark.sql import functions as F

from faunatally.operators.numbering import number_in_blocks, number_sorted


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_follow_the_sort_order_within_each_group(spark, partitions):
    draw = random.Random(partitions)
    rows = [(draw.choice(["a"] * 6 + ["b", None]), draw.choice([None, *range(400)]), k) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, v long, k long").repartition(partitions)
    got = {r.k: r.at for r in number_sorted(df, ["v", "k"], "at", per=["g"]).collect()}
    for group in ("a", "b", None):
        want = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in want] == list(range(len(want)))


def test_numbers_without_groups_and_of_no_rows(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    assert sorted((r.at, r.id) for r in number_sorted(df, ["v"], "at").collect()) == [(99 - k, k) for k in range(99, -1, -1)]
    assert number_sorted(df.where("id < 0"), ["v"], "at").collect() == []


def test_blocks_with_gaps_between_their_slots(spark):
    rows = [("f", 0, 10), ("f", 0, 11), ("f", 64, 900), ("g", 0, 5), ("g", 0, 6)]
    df = spark.createDataFrame(rows, "file string, start long, slot long")
    got = number_in_blocks(df, ["file", "start"], "slot", "at").select("slot", "at").collect()
    assert dict(map(tuple, got)) == {10: 0, 11: 1, 900: 2, 5: 3, 6: 4}
