import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.functions.parsing import read_double, strict_double, strict_int, strict_long


def parsed(spark, texts, parse):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(parse(F.col("t"))).collect()]


def test_integers_take_sign_and_digits_only(spark):
    cases = {"5": 5, "+5": 5, "-7": -7, "007": 7, " 5": None, "5 ": None, "5.0": None, "": None, "1e3": None,
             "2147483648": None, "5\n": None, "٥": None, "0x1": None}
    assert parsed(spark, list(cases), strict_int) == list(cases.values())


def test_longs_reach_their_range(spark):
    cases = {str(2**63 - 1): 2**63 - 1, str(-(2**63)): -(2**63), str(2**63): None}
    assert parsed(spark, list(cases), strict_long) == list(cases.values())


@pytest.mark.parametrize("text,value", [
    ("1", 1.0), ("-1.5", -1.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("+2E-2", 0.02), ("0x1.8p3", 12.0),
    ("inf", math.inf), ("-Infinity", -math.inf), ("1.0d", None), ("1f", None), (" 1", None), ("1e400", None),
    (".", None), ("", None), ("1e", None), ("+nan", None), ("0x1", None), ("1_000", None),
])
def test_doubles(spark, text, value):
    assert parsed(spark, [text], strict_double) == [value]
    if value is None:
        with pytest.raises(ValueError):
            read_double(text)
    else:
        assert read_double(text) == value


def test_nan_is_a_double(spark):
    assert math.isnan(parsed(spark, ["NaN"], strict_double)[0])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_every_finite_double_reads_back(spark, values):
    assert parsed(spark, [repr(v) for v in values], strict_double) == values
