from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hourledger.functions import convert, text


def value(spark, column, **inputs):
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in inputs.items())
    df = spark.createDataFrame([tuple(v for _, v in inputs.values())], schema)
    return df.select(column).first()[0]


def on_text(spark, function, given):
    return value(spark, function(F.col("x")), x=("string", given))


@pytest.mark.parametrize("given", [" a ", "\t a\n", "\r\na\x0b", "\xa0a　"])
def test_strip_removes_every_kind_of_white_space(spark, given):
    assert on_text(spark, text.strip, given) == given.strip() == "a"


@pytest.mark.parametrize(
    "email, valid",
    [
        ("someone@corp.example", True),
        ("  Some.One-2@CORP.example\n", True),
        ("josé_ñ@corp.example", True),
        ("someone@corp-example", False),
        ("someone@other.example", False),
        ("not-an-email", False),
        ("a b@corp.example", False),
        ("someone@corp.example.org", False),
        ("", False),
        (None, None),
    ],
)
def test_company_email(spark, email, valid):
    assert on_text(spark, lambda c: text.is_company_email(c, "Corp.example"), email) is valid


def test_missing_keywords_keep_their_order(spark):
    missing = on_text(spark, lambda c: text.missing_keywords(c, ["irae", "software", "desarrollo"]), "DESARROLLO de x")
    assert missing == ["irae", "software"]


def test_one_line(spark):
    assert on_text(spark, text.one_line, "a\nb\n") == "a b "


@pytest.mark.parametrize("given, number", [("1.5", 1.5), (" 2 ", 2.0), ("abc", None), ("", None), (None, None)])
def test_bad_numbers_are_null(spark, given, number):
    assert on_text(spark, convert.to_number, given) == number


@pytest.mark.parametrize(
    "given, day", [("2024-02-29", date(2024, 2, 29)), ("2024-13-01", None), ("x", None), (None, None)]
)
def test_bad_dates_are_null(spark, given, day):
    assert on_text(spark, convert.to_day, given) == day


@pytest.mark.parametrize(
    "given, day",
    [
        ("2024-06-01", date(2024, 6, 1)),
        ("2024-6-1", date(2024, 6, 1)),
        ("2024-06", None),
        ("2024-06-01T00:00:00", None),
        ("2023-02-29", None),
    ],
)
def test_iso_day_is_strict(spark, given, day):
    assert on_text(spark, convert.iso_day, given) == day


def test_iso_timestamp_with_and_without_micros(spark):
    df = spark.createDataFrame([("2025-07-07T15:00:00.123456",), ("2025-07-07T15:00:00",), ("soon",)], "t string")
    found = [row[0] for row in df.select(convert.to_time(df, "t")).collect()]
    assert found == [datetime(2025, 7, 7, 15, 0, 0, 123456), datetime(2025, 7, 7, 15), None]


@pytest.mark.parametrize("given, shown", [(5.25, "5.25"), (7.0, "7.00"), (0.1 + 0.2, "0.30"), (0.125, "0.13")])
def test_two_decimals(spark, given, shown):
    assert value(spark, convert.two_decimals(F.col("x")), x=("double", given)) == shown


def test_calendar_texts(spark):
    day = convert.day_literal("2025-07-11")
    row = spark.range(1).select(
        convert.long_day(day), convert.month_start(day), convert.year_text(day), convert.month_text(day)
    ).first()
    assert tuple(row) == ("Jul 11, 2025", date(2025, 7, 1), "2025", "07")
    assert convert.run_suffix(datetime(2025, 7, 11, 9, 30, 5)) == "2025-07-11_093005"
