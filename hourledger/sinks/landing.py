"""Landing files: users and hours of a period, as headed CSV."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourledger.functions import convert
from hourledger.functions.text import without_breaks

# Quotes doubled, as csv writers do; white space kept.
EXACT_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the load time, the same on every row, as the last column."""
    return df.withColumn("etl_time", F.lit(run_ts.isoformat()))


def landing_users(users: DataFrame, run_ts: datetime) -> DataFrame:
    """``id, firstName, lastName, email, etl_time``; missing text becomes empty text."""
    texts = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("firstName", "lastName", "email")]
    return stamp(users.select(F.col("id").cast("string").alias("id"), *texts), run_ts)


def landing_hours(
    summary: DataFrame, start: date | str, end: date | str, run_ts: datetime
) -> DataFrame:
    """``userId, total_billable_hours, start_date, end_date, etl_time``; hours as 2-decimal text."""
    rows = summary.select(
        F.col("userId").cast("string").alias("userId"),
        convert.two_decimals(F.col("total_billable_hours")).alias("total_billable_hours"),
        F.lit(str(start)).alias("start_date"),
        F.lit(str(end)).alias("end_date"),
    )
    return stamp(rows, run_ts)


def write_landing(df: DataFrame, folder: str, run_ts: datetime) -> str:
    """Write into a folder of its own under the table's landing folder; returns its path.

    A landing file holds one record per line, so that it can be split: line breaks inside a text
    become spaces.
    """
    target = f"{folder}/run={convert.run_suffix(run_ts)}"
    lines = df.withColumns({c: without_breaks(F.col(c)) for c, kind in df.dtypes if kind == "string"})
    lines.write.mode("append").options(header="true", emptyValue="", **EXACT_CSV).csv(target)
    return target
