"""Edge values for the parsing and scoring expressions."""

import pytest
from pyspark.sql import functions as F

from opslens.functions import numeric, parse, scores


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("12", 12), (" 12 ", 12), ("+5", 5), ("-3", -3), ("5.0", None), ("", None), ("n/a", None), (None, None),
])
def test_strict_int(spark, text, expected):
    assert one(spark, parse.parse_int(F.col("x")), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("$12.50", 12.5), (" $7 ", 7.0), ("$1,234.50", None), ("abc", None), ("", None),
])
def test_money_stream(spark, text, expected):
    assert one(spark, parse.parse_money_stream(F.col("x")), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("$1,234.50", 1234.5), ("$$1,000", 1000.0), ("12", 12.0), ("n/a", None), (None, None),
])
def test_money_etl(spark, text, expected):
    assert one(spark, parse.parse_money_etl(F.col("x")), text) == expected


@pytest.mark.parametrize("text,expected", [("3.5", 3.5), (None, 0.0), ("soon", 0.0), ("", 0.0)])
def test_double_or_zero(spark, text, expected):
    assert one(spark, parse.double_or_zero(F.col("x")), text) == expected


def test_first_present_does_not_fall_through(spark):
    df = spark.createDataFrame([
        ({"A": "1", "b": "2"},), ({"b": "2"},), ({"c": "3"},), ({"A": None, "b": "2"},), ({"A": "", "b": "2"},),
    ], "m map<string,string>")
    got = [r["r"] for r in df.select(parse.first_present(F.col("m"), ("A", "b")).alias("r")).collect()]
    assert got == ["1", "2", "0", None, ""]


@pytest.mark.parametrize("value,expected", [
    (0.125, 0.13), (0.135, 0.14), (0.5749999, 0.57), (-0.125, -0.13), (1.005, 1.01), (1e25, 1e25),
    (float("inf"), float("inf")), (None, None),
])
def test_round_half_up_decimal_first(spark, value, expected):
    assert one(spark, numeric.round_half_up(F.col("x"), 2), value, "x double") == expected


def test_json_number_tokens(spark):
    texts = ['{"f":1.0}', '{"f":"1.0"}', '{"f":2}', '{"f":1e3}', '{"f":true}', '{"f":null}', '{}', 'no json', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(parse.json_number(F.col("t"), "f").alias("v")).collect()] == [
        1.0, None, 2.0, 1000.0, None, None, None, None, None]


@pytest.mark.parametrize("life,energy,expected", [
    (100.0, 0.0, 0.0), (100.0, -2.0, 0.0), (100.0, 4.0, 25.0), (1e6, 1.0, 500.0), (-5.0, 1.0, 0.0),
    (None, 2.0, 0.0), (3.0, None, 0.0),
])
def test_machine_efficiency(spark, life, energy, expected):
    df = spark.createDataFrame([(life, energy)], "l double, e double")
    assert df.select(scores.machine_efficiency(F.col("l"), F.col("e")).alias("r")).first()["r"] == expected


def test_tiers(spark):
    df = spark.createDataFrame([(0.61,), (0.6,), (0.41,), (0.4,), (None,)], "x double")
    got = [r["r"] for r in df.select(scores.stream_segment(F.col("x")).alias("r")).collect()]
    assert got == ["HIGH_VALUE", "MEDIUM_VALUE", "MEDIUM_VALUE", "STANDARD", "STANDARD"]
    got = [r["r"] for r in df.select(scores.etl_segment(F.col("x")).alias("r")).collect()]
    assert got == ["MEDIUM_VALUE", "MEDIUM_VALUE", "STANDARD", "STANDARD", "STANDARD"]
