"""One row per key: the first in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_ROW = "__row"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key group.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each map task
    sends at most one row per key. A key holding a third of all rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str = "etl_time") -> DataFrame:
    """Keep the row with the highest version of every key; NULL versions come last.

    Equal versions are settled by the remaining columns, highest first, so the result does not
    depend on the order in which rows are read. NULL key parts form a group of their own.

    That order covers the whole row, so the latest row is the maximum of the row as a struct: an
    aggregate, which is combined before the shuffle like any other and sorts by the key only.
    """
    rest = [name for name in df.columns if name != version and name not in keys]
    latest = df.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias(_ROW))
    return latest.select(
        *[F.col(name) if name in keys else F.col(f"{_ROW}.{name}").alias(name) for name in df.columns]
    )
