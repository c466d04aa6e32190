"""Explicit schemas of every table and layer. Nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Landing files: CSV, every column text.
USERS_LANDING = _strings("id", "firstName", "lastName", "email", "etl_time")
HOURS_LANDING = _strings("userId", "total_billable_hours", "start_date", "end_date", "etl_time")

# API pages. Ids arrive as numbers or text, so they are read as text.
_META = T.StructField("meta", T.StructType([T.StructField("totalRows", T.LongType())]))


def page_of(item: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("data", T.ArrayType(item)), _META])


USERS_PAGE = page_of(_strings("id", "firstName", "lastName", "email"))
TASKS_PAGE = page_of(
    T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("projectId", T.StringType()),
            T.StructField("isNonBillable", T.IntegerType()),
        ]
    )
)
ENTRIES_PAGE = page_of(
    T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("userId", T.StringType()),
            T.StructField("projectId", T.StringType()),
            T.StructField("decimalHours", T.DoubleType()),
            T.StructField("date", T.StringType()),
        ]
    )
)

# Billable hours of each day with any, by user and month.
DAILY_HOURS = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("days", T.ArrayType(T.StructType([T.StructField("day", T.DateType()), T.StructField("hours", T.DoubleType())]))),
    ]
)

# History of email -> issuer company.
MAPPING = T.StructType(
    [
        T.StructField("email", T.StringType()),
        T.StructField("issuer_company", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Accepted invoices: headless quoted CSV under year=/month=. The month stays text ("06").
INVOICE_FILE_COLUMNS = ["email", "razon_social", "ruc_emisor", "amount_of_hours", "rate", "description"]
INVOICE_STORE = T.StructType(
    [
        T.StructField("email", T.StringType()),
        T.StructField("razon_social", T.StringType()),
        T.StructField("ruc_emisor", T.StringType()),
        T.StructField("amount_of_hours", T.DoubleType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """What the pipeline needs to know about one table."""

    name: str
    landing_schema: T.StructType
    keys: tuple[str, ...]
    clean: Callable[[DataFrame], DataFrame]
    version: str = "etl_time"
    # Storage partition of the std layer. The expression, of the number of buckets, must depend on
    # key columns only, so that a merge never has to look outside the partitions its updates fall into.
    partition: tuple[str, Callable[[int], Column]] | None = None
    # Where partitions are buckets: how many rows are wanted in one. Their number follows the table's size.
    rows_per_bucket: int | None = None
    # Columns whose distinct count the consistency check compares between layers.
    check_columns: tuple[str, ...] = ()
