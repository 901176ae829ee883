import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from bayline import functions as fn


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return row.select(expr.alias("v")).first()["v"]


def test_email_is_trimmed_of_any_space_and_lowered_before_hashing(spark):
    got = one(spark, fn.email_hash(F.col("e")), e="\t Ada@Example.TEST \n")
    assert got == hashlib.sha256(b"ada@example.test").hexdigest()


def test_last4(spark):
    assert one(spark, fn.last4(F.col("p")), p="555-0001234") == "1234"


@pytest.mark.parametrize("text, amount", [
    ("2.675", "2.68"), ("10", "10.00"), ("-3.5", "-3.50"), ("NaN", None), ("abc", None),
    ("", None), ("Infinity", None),
])
def test_money_is_exact_and_never_guesses(spark, text, amount):
    got = one(spark, fn.money(F.col("a")), a=text)
    assert (None if got is None else str(got)) == amount


def test_domain_counts_null_as_outside(spark):
    df = spark.createDataFrame([("recall",), ("x",), (None,)], "t string")
    got = [r.v for r in df.select(fn.in_domain(F.col("t"), ["recall"]).alias("v")).collect()]
    assert got == [True, False, False]


def test_calendar_attributes(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 2, 29),), (dt.date(2024, 12, 1),)], "d date")
    rows = [tuple(r) for r in df.select(*fn.calendar_attributes(F.col("d"))).collect()]
    assert rows == [
        (20240229, dt.date(2024, 2, 29), 2024, 1, 2, "February", 0),
        (20241201, dt.date(2024, 12, 1), 2024, 4, 12, "December", 1),
    ]


def test_boundaries_are_counted_not_elapsed_time(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 1))], "a date, b date")
    got = df.select(
        fn.year_boundaries(F.col("a"), F.col("b")), fn.month_boundaries(F.col("a"), F.col("b"))
    ).first()
    assert tuple(got) == (1, 1)


def test_ratio_is_exact_half_up_and_null_on_zero(spark):
    assert str(one(spark, fn.ratio(F.lit(641), F.lit(200), 2))) == "3.21"
    assert str(one(spark, fn.share_pct(F.lit(1), F.lit(8)))) == "12.5"
    assert one(spark, fn.ratio(F.lit(1), F.lit(0), 2)) is None
