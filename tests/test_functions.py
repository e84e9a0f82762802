import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from farebox.functions import (
    date_key, duration_minutes_2dp, exact_mean_2dp, half_even_int, round_exact_ratio_2dp,
    money_2dp, money_sum, round_numeric, surrogate_key,
)


def test_half_even_int(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,), (-1.5,), (2.4999,)], "x double")
    got = [r[0] for r in df.select(half_even_int("x")).collect()]
    assert got == [0, 2, 2, None, -2, 2]


def test_round_numeric_15_digit_rule(spark):
    df = spark.createDataFrame([(12.344999999999999,), (None,), (-12.345,), (0.005,), (1e-7,), (1e15,),
                                (123456789.125,)], "x double")
    got = [r[0] for r in df.select(round_numeric("x")).collect()]
    assert got == [Decimal("12.35"), None, Decimal("-12.35"), Decimal("0.01"), Decimal("0.00"),
                   Decimal("1000000000000000.00"), Decimal("123456789.13")]
    assert dict(df.select(round_numeric("x").alias("r")).dtypes)["r"] == "decimal(18,2)"


@pytest.mark.parametrize("x", [float("nan"), float("inf"), 1e17])
def test_round_numeric_never_loses_a_value(spark, x):
    df = spark.createDataFrame([(x,), (5.0,)], "x double")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE|OVERFLOW"):
        df.select(F.sum(round_numeric("x"))).collect()


def test_plain_and_text_rounding_agree(spark):
    """Where the text form is not used, it would have given the same."""
    rng = random.Random(4)
    xs = [rng.choice((1, -1)) * rng.random() * 10 ** rng.randint(-4, 10) for _ in range(4000)]
    xs += [round(x, 2) + 0.005 for x in xs[:2000]]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    text = F.round(F.format_string("%.15g", F.col("x")).cast("decimal(38,15)"), 2).cast("decimal(18,2)")
    assert df.where(~round_numeric("x").eqNullSafe(text)).count() == 0


def test_money_is_rounded_once(spark):
    df = spark.createDataFrame([(0.0044,)] * 10 + [(1.0012,)], "x double")
    assert df.select(money_2dp(money_sum("x"))).first()[0] == Decimal("1.05")


def test_exact_mean_single_rounding(spark):
    # 0.0049996 would become 0.005000 with a scale-6 intermediate, then 0.01
    df = spark.createDataFrame([(Decimal("0.049996"), 10), (Decimal("10"), 3), (Decimal("-0.125"), 1),
                                (Decimal("5"), 0)], "s decimal(38,6), n long")
    got = [r[0] for r in df.select(exact_mean_2dp(F.col("s"), F.col("n"), 6)).collect()]
    assert got == [Decimal("0.00"), Decimal("3.33"), Decimal("-0.13"), None]


def test_ratio(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("1"), Decimal("0"))],
                               "a decimal(38,2), b decimal(38,2)")
    got = [r[0] for r in df.select(round_exact_ratio_2dp(F.col("a"), F.col("b"), 2, 100)).collect()]
    assert got == [Decimal("33.33"), None]


def test_duration_minutes_2dp(spark):
    df = spark.createDataFrame([(59_999_999,), (60_000_000,), (299_999,), (300_000,), (-300_000,)], "u long")
    got = [r[0] for r in df.select(duration_minutes_2dp("u")).collect()]
    assert got == [Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), Decimal("0.01"), Decimal("-0.01")]


def test_surrogate_key_null_is_empty_and_separator_kept(spark):
    df = spark.createDataFrame([(None, 10.0), ("a", None)], "a string, b double")
    got = [r[0] for r in df.select(surrogate_key(["a", "b"])).collect()]
    import hashlib
    assert got == [hashlib.md5(b"|10.0").hexdigest(), hashlib.md5(b"a|").hexdigest()]


def test_date_key(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05 23:59:59' as t, date'1999-12-31' as d")
    assert df.select(date_key("t"), date_key("d")).first() == (20240105, 19991231)
