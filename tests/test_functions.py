from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from tillbook import functions as fn
from tillbook.session import require_ansi


def apply(spark, function, inputs):
    df = spark.createDataFrame([(index, text) for index, text in enumerate(inputs)], "n int, text string")
    return [row[0] for row in df.orderBy("n").select(function(F.col("text"))).collect()]


def test_strict_number_fails_on_text_and_keeps_null(spark):
    assert apply(spark, fn.to_number, ["7", " 7 ", None]) == [Decimal(7), Decimal(7), None]
    with pytest.raises(NumberFormatException):
        apply(spark, fn.to_number, ["7", "seven"])


def test_strict_number_holds_38_digits(spark):
    assert apply(spark, fn.to_number, ["9" * 38]) == [Decimal("9" * 38)]


def test_strict_casts_refuse_a_lenient_session(spark):
    lenient = spark.newSession()
    lenient.conf.set("spark.sql.ansi.enabled", "false")
    with pytest.raises(RuntimeError):
        require_ansi(lenient.range(1))


def test_safe_number(spark):
    inputs = ["3", "2.7", "2.5", "-2.5", "abc", "", "1,000", " 5 ", "1e2", None, "9" * 39]
    expected = [3, 3, 3, -3, None, None, None, 5, 100, None, None]
    assert apply(spark, fn.try_number, inputs) == expected


def test_safe_decimal(spark):
    got = apply(spark, lambda c: fn.try_decimal(c, 10, 2), ["799", "1.005", "free", "123456789.00", None])
    assert got == [Decimal("799.00"), Decimal("1.01"), None, None, None]


def test_safe_date_and_timestamp(spark):
    dates = ["2024-01-15", "2024-13-15", "soon", "15-JAN-2024", "01/15/2024", "13/15/2024", None]
    day = dt.date(2024, 1, 15)
    assert apply(spark, fn.try_date, dates) == [day, None, None, day, day, None, None]
    assert apply(spark, lambda c: fn.try_date(c, layouts=()), dates) == [day, None, None, None, None, None, None]
    moments = ["2024-05-01 10:22:00", "2024-13-01 10:22:00", "soon", None]
    assert apply(spark, fn.try_timestamp, moments) == [dt.datetime(2024, 5, 1, 10, 22), None, None, None]


def test_title_case(spark):
    expected = {
        "anne-marie": "Anne-Marie",
        "USB-C hub": "Usb-C Hub",
        "o'brien": "O'brien",
        "NEW   delhi": "New   Delhi",
        "a\tb": "A\tB",
        "(east)/west": "(East)/West",
        "x_y&z": "X_Y&Z",
        "3rd st": "3rd St",
        "-": "-",
        "": "",
        None: None,
    }
    assert apply(spark, fn.title_case, list(expected)) == list(expected.values())


def test_trimmed_text(spark):
    assert apply(spark, fn.title_trimmed, ["  sara KHAN "]) == ["Sara Khan"]
    assert apply(spark, fn.lower_trimmed, [" A@B.C "]) == ["a@b.c"]
    assert apply(spark, fn.upper_trimmed, [" completed "]) == ["COMPLETED"]


def test_null_tokens(spark):
    assert apply(spark, fn.null_tokens, ["", "NULL", "null", "x", None]) == [None, None, "null", "x", None]


def test_null_is_the_largest_value(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [row.v for row in df.orderBy(fn.ascending("v")).collect()] == [1, 2, None]
    assert [row.v for row in df.orderBy(fn.descending("v")).collect()] == [None, 2, 1]


def test_days_between(spark):
    df = spark.sql("SELECT date '2024-05-20' AS a, date '2024-06-01' AS b")
    row = df.select(fn.days_between(F.col("a"), F.col("b")), fn.days_between(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (12, -12)
