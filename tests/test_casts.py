import math

import pytest

from tripgauge.functions import casts
from pyspark.sql import types as T

TEXT, REAL = T.StringType(), T.DoubleType()


def _value(spark, expr):
    return spark.range(1).selectExpr(f"{expr} AS v").first().v


@pytest.mark.parametrize("text,wanted", [
    ("1", 1), ("1.0", 1), ("2.5", 3), ("1e3", 1000), (" 7 ", 7), ("-4", -4), ("+4", 4),
    ("9007199254740993", 9007199254740993), ("abc", None), ("", None), ("1.5d", None),
    ("1e30", None), ("nan", None),
])
def test_text_to_long(spark, text, wanted):
    assert _value(spark, casts.to_long(f"'{text}'", TEXT)) == wanted


@pytest.mark.parametrize("number,wanted", [(2.5, 2), (3.5, 4), (2.4, 2), (-2.5, -2)])
def test_double_to_long_rounds_half_even(spark, number, wanted):
    assert _value(spark, casts.to_long(f"{number}D", REAL)) == wanted


@pytest.mark.parametrize("text,wanted", [
    ("1.5", 1.5), (".5", 0.5), ("5.", 5.0), ("1.5d", None), ("2f", None), ("1e-3", 0.001),
    ("x", None), ("Infinity", math.inf), ("-inf", -math.inf),
])
def test_text_to_double(spark, text, wanted):
    assert _value(spark, casts.to_double(f"'{text}'", TEXT)) == wanted


def test_text_nan(spark):
    assert math.isnan(_value(spark, casts.to_double("'NaN'", TEXT)))


@pytest.mark.parametrize("text,readable", [
    ("2023-01-10 08:00:00", True), ("2023-01-10T08:00:00.123", True), ("2023-01-10", True),
    ("2023", False), ("2023-01", False), ("soon", False), ("", False),
])
def test_text_to_timestamp(spark, text, readable):
    assert (_value(spark, casts.to_timestamp(f"'{text}'", TEXT)) is not None) == readable


def test_round_like_the_expected_results(spark):
    assert _value(spark, casts.rounded("1.005D", 2)) == 1.0
    assert _value(spark, casts.rounded("2.675D", 2)) == 2.68


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:  # a clock change lies between the two
        expr = casts.seconds_between("TIMESTAMP_NTZ'2023-03-12 01:00:00'",
                                     "TIMESTAMP_NTZ'2023-03-12 04:00:00.25'")
        assert _value(spark, expr) == 10800.25
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_interpolation_keeps_the_product_error(spark):
    for low, high, w in [(111.9, 351.8, 0.3), (43.98, 304.32, 0.8), (89.71, 465.21, 0.6)]:
        got = _value(spark, casts.interpolated(f"{low!r}D", f"{high!r}D", f"{w!r}D"))
        assert got == math.fma(low, 1 - w, high * w)


def test_decimal_rounding_equals_exact_arithmetic(spark):
    from decimal import ROUND_HALF_EVEN, Decimal
    import random

    rng = random.Random(8)
    values = [k / 128 for k in range(-300, 300)] + [k * 0.005 for k in range(-999, 999)] + [k / 2 for k in range(-9, 10)]
    values += [1.005, 2.675, 0.5, 1e-300, 4503599627370497.5, 9007199254740993.0, 1e300, 45035996273704.97, 0.1 + 0.2]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 18) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 6, 8, 11):
        got = [r.r for r in df.selectExpr(f"{casts.rounded_decimal('v', digits)} AS r").collect()]
        unit = Decimal(1).scaleb(-digits)
        exact = [float((Decimal(v) / unit).to_integral_value(ROUND_HALF_EVEN) * unit) if abs(v) < 1e15 else round(v, digits) for v in values]
        assert got == exact == [round(v, digits) for v in values]


def test_decimal_rounding_of_no_number(spark):
    assert _value(spark, casts.rounded_decimal("CAST(NULL AS DOUBLE)", 6)) is None
    assert math.isnan(_value(spark, casts.rounded_decimal("double('NaN')", 6)))
    assert _value(spark, casts.rounded_decimal("double('-Infinity')", 2)) == -math.inf
    with pytest.raises(ValueError):
        casts.rounded_decimal("1D", 12)
