import hashlib
import math

import pytest
from pyspark.sql import functions as F

from outcomekit import functions as fn


def test_lenient_double_reads_only_numbers(spark):
    texts = ["29.85", " ", "", None, " 3.5 ", "1e3", "1,000", "1d", "nan", "inf", "+5", ".5", "5.", "0x10", "1_000"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    got = [r[0] for r in df.orderBy("id").select(fn.lenient_double("v")).collect()]
    want = [29.85, None, None, None, 3.5, 1000.0, None, None, None, math.inf, 5.0, 0.5, 5.0, None, None]
    assert got == want


def test_map_values_leaves_unmapped_null(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "c string")
    assert [r[0] for r in df.select(fn.map_values("c", {"Yes": 1, "No": 0})).collect()] == [1, 0, None, None]


def test_threshold_strict_and_inclusive(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "p double")
    row = df.select(fn.threshold_label("p").alias("a"), fn.threshold_label("p", inclusive=True).alias("b")).collect()
    assert [(r.a, r.b) for r in row] == [(0, 0), (0, 1), (1, 1)]


def test_draw_is_the_leading_hash_digits(spark):
    want = int(hashlib.md5(b"17|42|split").hexdigest()[:8], 16)
    assert spark.range(17, 18).select(fn.draw("id", 42, "split")).first()[0] == want


def test_rules_take_the_first_match_and_mind_case(spark):
    rules = [(["tenure"], "a"), (["Contract"], "b"), (["OnlineSecurity", "TechSupport"], "c")]
    names = ["tenure", "Contract_Two year", "TechSupport_Yes", "contract", "tenure_Contract"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(fn.first_match("f", rules, "z")).collect()] == ["a", "b", "c", "z", "a"]
    hits = df.select(fn.any_substring("f", ["Contract"])).collect()
    assert [r[0] for r in hits] == [False, True, False, False, True]


def test_formats(spark):
    df = spark.createDataFrame([(0.67834, 1234567)], "x double, n bigint")
    row = df.select(fn.fixed_decimals("x"), fn.percent_text("x"), fn.thousands_text("n")).first()
    assert list(row) == ["0.6783", "67.8%", "1,234,567"]
    empty = spark.createDataFrame([(None, None)], "x double, n bigint")
    assert list(empty.select(fn.fixed_decimals("x"), fn.percent_text("x"), fn.thousands_text("n")).first()) == [None] * 3


def test_loss_is_finite_at_certain_scores(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0), (1, 1.0)], "y int, p double")
    values = [r[0] for r in df.select(fn.bce_loss("y", "p")).collect()]
    assert values[0] == pytest.approx(-math.log(1e-7)) and values[1] == pytest.approx(-math.log(1e-7), rel=1e-6)
    assert values[2] == pytest.approx(0.0, abs=1e-6)


def test_linear_margin_and_sigmoid(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    margin = fn.linear_margin({"a": 0.5, "b": -1.0}, 2.0)
    assert df.select(margin).first()[0] == 0.0
    assert df.select(fn.sigmoid(margin)).first()[0] == 0.5


def test_squared_distance(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(fn.squared_distance(F.col("a"), F.col("b"), 2)).first()[0] == 25.0
