"""Dashboard frames over the std tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourledger.operators.reduced import join_reduced


def hours_with_email(hours: DataFrame, users: DataFrame) -> DataFrame:
    """Hours with the user's email; ``display_user`` is the email, else the user id."""
    emails = users.select(F.col("id").alias("userId"), "email")
    return join_reduced(hours, emails, ["userId"]).withColumn("display_user", F.coalesce("email", "userId"))


def kpis(users: DataFrame, hours: DataFrame) -> DataFrame:
    """One row: ``total_users, total_billable_hours``.

    Overlapping periods of a user count twice. NaN hours are skipped.
    """
    value = F.col("total_billable_hours")
    people = users.agg(F.count_distinct("id").alias("total_users")).withColumn(
        "total_billable_hours", F.lit(None).cast("double")
    )
    total = F.round(F.coalesce(F.sum(F.when(~F.isnan(value), value)), F.lit(0.0)), 2)
    booked = hours.agg(total.alias("total_billable_hours")).withColumn(
        "total_users", F.lit(None).cast("bigint")
    )
    return people.unionByName(booked).agg(
        F.max("total_users").alias("total_users"),
        F.max("total_billable_hours").alias("total_billable_hours"),
    )


def display_users(hours: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct display names of users with hours, sorted.

    The hours are reduced to their distinct users before the join.
    """
    booked = hours.select("userId").distinct()
    named = hours_with_email(booked, users).select("display_user")
    return named.where(F.col("display_user").isNotNull()).distinct().orderBy("display_user")


def user_series(hours: DataFrame, users: DataFrame, display_user: str) -> DataFrame:
    """Hours of one display user over time.

    The name is resolved to the few matching user ids first, so both scans are filtered instead
    of joining everything and filtering afterwards.
    """
    wanted = F.lit(display_user)
    by_email = users.where(F.col("email") == wanted).select(F.col("id").alias("userId"))
    by_id = users.where(F.col("id") == wanted).select(F.col("id").alias("userId"), "email")
    # A user id is shown as such only where that user has no email.
    named_by_id = by_id.where(F.col("email").isNotNull()).select("userId")
    bare = hours.where(F.col("userId") == wanted).join(named_by_id, "userId", "left_anti")
    emailed = hours.join(by_email, "userId", "left_semi")
    return (
        emailed.unionByName(bare)
        .select(wanted.alias("display_user"), "start_date", "end_date", "total_billable_hours")
        .orderBy("start_date", "end_date")
    )
