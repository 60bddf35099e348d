import pytest
from pyspark.sql import functions as F

from faunatally.functions import (
    DEPTH_ZONES,
    band_label,
    band_position,
    first_word,
    half_even,
    if_known,
    listed_in,
    marked_name,
    not_blank,
    not_listed_in,
    number_text,
    percent,
    range_text,
)


def values(spark, schema, rows, expression):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_listed_in_gives_an_answer_for_null(spark):
    rows = [("a",), ("b",), (None,)]
    assert values(spark, "x string", rows, listed_in(F.col("x"), ["a"])) == [True, False, False]
    assert values(spark, "x string", rows, not_listed_in(F.col("x"), ["a"])) == [False, True, True]


def test_not_blank_is_not_true_for_null_or_empty(spark):
    assert values(spark, "x string", [("a",), ("",), (None,)], not_blank(F.col("x"))) == [True, False, None]


def test_if_known_keeps_null(spark):
    rows = [(1,), (0,), (None,)]
    assert values(spark, "x int", rows, if_known(F.col("x") == 1, F.lit("y"), F.lit("n"))) == ["y", "n", None]


def test_half_even(spark):
    assert values(spark, "x double", [(2.5,), (3.5,), (None,)], half_even(F.col("x"), 0)) == [2.0, 4.0, None]
    assert values(spark, "x double", [(6.25,), (6.35,)], half_even(F.col("x"), 1)) == [6.2, 6.4]


@pytest.mark.parametrize("part, whole, digits, want", [(1, 16, 1, 6.2), (1, 16, 0, 6.0), (1, 40, 0, 2.0), (1, 0, 1, None)])
def test_percent(spark, part, whole, digits, want):
    got = values(spark, "p bigint, w bigint", [(part, whole)], percent(F.col("p"), F.col("w"), digits))
    assert got == [want]


def test_number_text(spark):
    rows = [(1200.0,), (1200.5,), (0.0,), (None,)]
    assert values(spark, "x double", rows, number_text(F.col("x"))) == ["1200", "1200.5", "0", None]


def test_number_text_is_plain_and_short(spark):
    texts = {
        12345678.5: "12345678.5",
        0.0001: "0.0001",
        0.1 + 0.2: "0.3",
        -0.1 - 0.2: "-0.3",
        1e-7: "0.0000001",
        123456.789012345: "123456.789012345",
        0.1: "0.1",
        100.0: "100",
        1e6: "1000000",
        99.99999999999999: "100",
        999999999999999.0: "999999999999999",
        1e15: "1000000000000000",
        1e22: "10000000000000000000000",
        2.5e-5: "0.000025",
        -0.0: "0",
        1 / 3: "0.333333333333333",
        float("nan"): None,
        float("inf"): None,
    }
    assert values(spark, "x double", [(x,) for x in texts], number_text(F.col("x"))) == list(texts.values())


def test_number_text_of_other_numbers(spark):
    assert values(spark, "x bigint", [(5,), (None,), (-12,)], number_text(F.col("x"))) == ["5", None, "-12"]


def test_number_text_reads_back(spark):
    import random

    draw = random.Random(3)
    numbers = [draw.uniform(-1, 1) * 10 ** draw.randint(-6, 12) for _ in range(2000)]
    texts = values(spark, "x double", [(x,) for x in numbers], number_text(F.col("x")))
    for x, text in zip(numbers, texts):
        assert "e" not in text.lower() and abs(float(text) - x) <= abs(x) * 1e-14
        assert len(text.replace("-", "").replace(".", "").lstrip("0")) <= 15
        assert not ("." in text and text.endswith("0"))


def test_range_text(spark):
    rows = [(5.0, 5.0), (5.0, 7.5), (None, None)]
    assert values(spark, "a double, b double", rows, range_text(F.col("a"), F.col("b"))) == ["5", "5 - 7.5", None]


def test_first_word(spark):
    rows = [("Aus bus",), ("Aus",), (" bus",), ("",), (None,)]
    assert values(spark, "x string", rows, first_word(F.col("x"))) == ["Aus", "Aus", None, None, None]


def test_marked_name(spark):
    rows = [
        ("Aus bus", "Fam"),
        ("Aus", "Fam"),
        ("Fam", "Fam"),
        ("Ordo", ""),
        ("Ordo", None),
        ("Aus bus", None),
        (None, "Fam"),
    ]
    got = values(spark, "n string, f string", rows, marked_name(F.col("n"), F.col("f")))
    assert got == ["*Aus bus*", "*Aus* sp.", "Fam", "Ordo", "Ordo", "*Aus bus*", None]


def test_depth_zones_at_their_edges(spark):
    rows = [(0.0,), (699.5,), (700.0,), (1500.0,), (1500.5,), (None,)]
    label = band_label(F.col("d"), DEPTH_ZONES)
    shallow, middle, deep = (b.label for b in DEPTH_ZONES)
    assert values(spark, "d double", rows, label) == [shallow, shallow, middle, middle, deep, None]
    assert values(spark, "d double", rows, band_position(label, DEPTH_ZONES)) == [1, 1, 2, 2, 3, None]
