"""Keys seen so far, one row each, extended batch by batch: distinct counts without reading what is old."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourledger import files


def extend_keys(batch: DataFrame, columns: Sequence[str], path: str) -> None:
    """Add the keys of a batch that are not there yet.

    A single column's NULL is no key; of several, NULL parts are part of the key, as in
    ``quality.distinct_count``. A batch may come again, or have been cut off while it was added: keys
    that are there are not added twice.
    """
    spark = batch.sparkSession
    found = batch.select(*columns).distinct()
    if len(columns) == 1:
        found = found.where(F.col(columns[0]).isNotNull())
    if files.has_file(spark, path, ".parquet"):
        known = spark.read.schema(found.schema).parquet(path).toDF(*[f"__known_{name}" for name in columns])
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"__known_{name}")) for name in columns])
        found = found.join(known, same, "left_anti")
    found.write.mode("append").parquet(path)


def count_keys(spark: SparkSession, path: str) -> int:
    """How many keys there are, from the files' footers."""
    return spark.read.parquet(path).count() if files.has_file(spark, path, ".parquet") else 0
