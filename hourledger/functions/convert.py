"""Conversions from landed text. Bad input becomes NULL; ANSI mode stays on."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(column: Column) -> Column:
    return column.try_cast("double")


def to_flag(column: Column) -> Column:
    """Text of a whole number (``1``, ``1.0``) or of a truth value to an integer."""
    number = to_number(column)
    truth = F.when(F.lower(F.trim(column)) == "true", 1).when(F.lower(F.trim(column)) == "false", 0)
    return F.coalesce(truth, F.when(number == F.floor(number), number.try_cast("int")))


def to_day(column: Column) -> Column:
    return column.try_cast("date")


def iso_day(column: Column) -> Column:
    """Strict ``YYYY-M-D`` text to a date; the looser forms a plain cast accepts are NULL."""
    return F.when(column.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), column.try_cast("date"))


def to_time(df: DataFrame, name: str) -> Column:
    """Text to a timestamp; a column that already is a timestamp is left alone."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.try_cast("timestamp")
    return column


def two_decimals(column: Column) -> Column:
    """Text with exactly two decimals.

    Rounds half up on the decimal value, so an exact tie (0.125) gives 0.13. Hours entered with
    two decimals, and sums of them, never hit that tie.
    """
    return F.round(column, 2).cast("decimal(18,2)").cast("string")


def month_start(column: Column) -> Column:
    return F.trunc(column, "MM")


def year_text(column: Column) -> Column:
    return F.date_format(column, "yyyy")


def month_text(column: Column) -> Column:
    return F.date_format(column, "MM")


def long_day(column: Column) -> Column:
    """``Jul 11, 2025``."""
    return F.date_format(column, "MMM dd, yyyy")


def run_suffix(run_ts: datetime) -> str:
    """``2025-07-11_093000``: names one load, so loads do not overwrite one another."""
    return run_ts.strftime("%Y-%m-%d_%H%M%S")


def day_literal(day: date | str) -> Column:
    return F.lit(str(day)).cast("date")
