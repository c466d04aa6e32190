"""Raw layer -> std layer rows: filter, trim, type, keep the latest version.

Filters run before the deduplication: if the newest row of a key is invalid, the newest valid
one survives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourledger.functions import convert
from hourledger.operators.latest import latest_per_key

USER_KEYS = ("id",)
HOURS_KEYS = ("userId", "start_date", "end_date")


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def require_valid_hours(df: DataFrame, column: str = "total_billable_hours") -> DataFrame:
    """Type the hours and drop negative or unreadable ones. NaN is not negative and stays."""
    return df.withColumn(column, convert.to_number(F.col(column))).where(F.col(column) >= 0)


def clean_users(raw: DataFrame) -> DataFrame:
    typed = require_key(raw, "id").withColumns(
        {
            "email": F.trim("email"),
            "firstName": F.upper(F.trim("firstName")),
            "lastName": F.upper(F.trim("lastName")),
            "etl_time": convert.to_time(raw, "etl_time"),
        }
    )
    return latest_per_key(typed, USER_KEYS)


def clean_hours(raw: DataFrame) -> DataFrame:
    valid = require_valid_hours(require_key(raw, "userId"))
    typed = valid.withColumns(
        {
            "start_date": convert.to_day(F.col("start_date")),
            "end_date": convert.to_day(F.col("end_date")),
            "etl_time": convert.to_time(raw, "etl_time"),
        }
    )
    return latest_per_key(typed, HOURS_KEYS)
