"""Property tests: rounding, strict integer parsing, alias resolution."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opslens.functions import numeric, parse

@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=40))
def test_rounding_keeps_what_has_no_decimals(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for got, x in zip([r.v for r in df.select(numeric.round_half_up("x").alias("v")).collect()], values, strict=True):
        if math.isnan(x):
            assert math.isnan(got)
        elif math.isinf(x) or abs(x) >= 1e20:
            assert got == x
        else:
            assert abs(got - x) <= 0.005 + abs(x) * 1e-15 + 1e-9


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(min_value=-10**12, max_value=10**12).map(str),
                          st.sampled_from(["", "n/a", "5.0", "1e3", " 7 ", "+8", "--1", "0x10"])),
                min_size=1, max_size=30))
def test_strict_int_matches_python_int(spark, texts):
    def py(t):
        try:
            return int(t.strip()) if "_" not in t else None
        except ValueError:
            return None
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.v for r in df.select(parse.parse_int(F.col("x")).alias("v")).collect()]
    assert got == [py(t) for t in texts]


KEYS = ("Purchase_Amount", "purchase_amount", "PurchaseAmount")
record = st.dictionaries(st.sampled_from(KEYS + ("other",)), st.one_of(st.none(), st.sampled_from(["", "1", "$2.50"])))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=20))
def test_first_present_matches_nested_get(spark, records):
    df = spark.createDataFrame([(r,) for r in records], "m map<string,string>")
    got = [r.v for r in df.select(parse.first_present(F.col("m"), KEYS).alias("v")).collect()]
    assert got == [r.get(KEYS[0], r.get(KEYS[1], r.get(KEYS[2], "0"))) for r in records]
