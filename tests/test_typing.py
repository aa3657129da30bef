import math

from conftest import rows, ts
from pyspark.sql import functions as F

from tideline.functions import typing as ty


def values(spark, texts, expression):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_doubles_round_half_to_even(spark):
    texts = ["2.5", "3.5", "2.7", "-2.5", "4021.0", "nan", "3e9", "", "x", None]
    assert values(spark, texts, ty.try_int(F.col("x"))) == [2, 4, 3, -2, 4021, None, None, None, None, None]


def test_clean_double_and_suffixes(spark):
    texts = ["1.5", " 2 ", "nan", "NaN", "1d", "2.5F", "", "abc", None]
    assert values(spark, texts, ty.clean_double(F.col("x"))) == [1.5, 2.0] + [None] * 7
    infinite = values(spark, ["inf", "-Infinity"], ty.try_double(F.col("x")))
    assert infinite == [math.inf, -math.inf]


def test_timestamp_spellings(spark):
    texts = ["2024-01-02", "2024-01-02 03:04", "2024-01-02T03:04:05", "2024/1/2"]
    want = [ts("2024-01-02"), ts("2024-01-02 03:04"), ts("2024-01-02 03:04:05"), ts("2024-01-02")]
    assert values(spark, texts, ty.try_timestamp(F.col("x"))) == want
    bad = ["nan", "", "2024", "2024-01", " 2024-01-02", "2024-01-02 ", "2024-01-02 03", "2024-13-01", "x", None]
    assert values(spark, bad, ty.try_timestamp(F.col("x"))) == [None] * len(bad)


def test_marker_is_null_and_filtered(spark):
    frame = spark.createDataFrame([("a",), ("nan",), (None,)], "x string")
    assert rows(frame.select(ty.null_if_marker(F.col("x")))) == [("a",), (None,), (None,)]
    assert rows(frame.where(ty.not_marker(F.col("x")))) == [("a",)]


def test_positive_flag_treats_nan_two_ways(spark):
    texts = ["1", "0", "nan", None]
    number = F.col("x").cast("double")
    assert values(spark, texts, ty.positive_flag(number)) == [True, False, False, False]
    assert values(spark, texts, ty.positive_flag_nan_high(number)) == [True, False, True, False]


def test_ratio_guards_zero(spark):
    frame = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (6.0, None), (None, 2.0)], "a double, b double")
    assert rows(frame.select(ty.ratio(F.col("a"), F.col("b")))) == [(3.0,), (None,), (None,), (None,)]


def test_markers_are_taken_out_before_the_cast_of_texts_and_typed_numbers_stay(spark):
    df = spark.createDataFrame([("nan", 1, 0.5), ("2.5", None, float("nan"))], "t string, i int, d double")
    for read in (ty.strict_double, ty.clean_double):
        out = df.select(*[read(F.col(c)).alias(c) for c in df.columns])
        assert rows(out) == [(None, 1.0, 0.5), (2.5, None, None)]
        assert "nan" in out._jdf.queryExecution().optimizedPlan().toString()
