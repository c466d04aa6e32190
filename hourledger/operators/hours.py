"""Billable hours per user for a period."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.functions import convert
from hourledger.operators.reduced import join_reduced


def _usable_project(tasks: DataFrame) -> Column:
    """Project id is present: not NULL, not 0, not empty."""
    column = F.col("projectId")
    if isinstance(tasks.schema["projectId"].dataType, T.StringType):
        return column.isNotNull() & ~column.isin("", "0")
    return column.isNotNull() & (column != 0)


def is_billable_task() -> Column:
    flag = F.col("isNonBillable")
    return flag.isNull() | (flag == 0)


def billable_projects(tasks: DataFrame) -> DataFrame:
    """Distinct ids of projects with at least one billable task."""
    return tasks.where(is_billable_task() & _usable_project(tasks)).select("projectId").distinct()


def entries_in_period(
    entries: DataFrame, start: date | str, end: date | str, user_id: str | int | None = None
) -> DataFrame:
    """Entries from ``start`` to ``end``, both included, optionally of one user."""
    kept = entries.where(F.col("entry_date").between(convert.day_literal(start), convert.day_literal(end)))
    if user_id:
        kept = kept.where(F.col("userId") == F.lit(user_id))
    return kept


def entries_on(entries: DataFrame, projects: DataFrame) -> DataFrame:
    """Entries booked on one of the projects. An entry without project matches none."""
    return join_reduced(entries, projects, ["projectId"], "left_semi")


def hours_per(entries: DataFrame, *by: str, name: str = "total_billable_hours") -> DataFrame:
    """Sum of hours by the given columns; missing hours count 0, NULL keys are one group."""
    hours = F.coalesce(F.col("decimalHours"), F.lit(0.0))
    return entries.groupBy(*by).agg(F.sum(hours).alias(name))


def billable_hours(
    entries: DataFrame,
    tasks: DataFrame,
    start: date | str,
    end: date | str,
    user_id: str | int | None = None,
) -> DataFrame:
    """Billable hours per user in a period: the flagship query."""
    period = entries_in_period(entries, start, end, user_id)
    return hours_per(entries_on(period, billable_projects(tasks)), "userId")
