"""Headed landing CSV files, any depth under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger import files
from hourledger.functions import convert

# Columns that go with each line of a file: the line itself where it is no record of the schema, and
# the file it is from.
DAMAGED, FILE = "__damaged_line", "__file"

# Each file's header is checked against the schema, name by name: a file with other or reordered
# columns fails the load instead of being misread by position. Quotes are doubled, as csv
# writers do. A file holds one record per line, so that it can be split; all columns are parsed,
# whichever are asked for, since a line with too few or too many is only seen that way.
LANDING_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "escape": '"',
    "pathGlobFilter": "*.csv",
    "recursiveFileLookup": "true",
    "columnPruning": "false",
    "columnNameOfCorruptRecord": DAMAGED,
}


class NoLandingFiles(RuntimeError):
    """The landing folder of a table holds no CSV file."""


def type_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("etl_time", convert.to_time(df, "etl_time"))


def loaded_schema(schema: T.StructType) -> T.StructType:
    """What rows of a landing schema are once read: the load time is a time."""
    return T.StructType([T.StructField(f.name, T.TimestampType()) if f.name == "etl_time" else f for f in schema])


def _marked_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(DAMAGED, T.StringType())])


def _with_file(lines: DataFrame) -> DataFrame:
    return type_load_time(lines.withColumn(FILE, F.col("_metadata.file_path")))


def require_files(spark: SparkSession, *paths: str) -> None:
    if not any(files.has_file(spark, path, ".csv") for path in paths):
        raise NoLandingFiles(f"no CSV files under {' or '.join(paths)}")


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All ``*.csv`` files under ``path``; every column text but the load time.

    Reading fails at a line that has not as many values as the header has names.
    """
    require_files(spark, path)
    return type_load_time(spark.read.schema(schema).options(mode="FAILFAST", **LANDING_OPTIONS).csv(path))


def read_landing_lines(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The same of several folders, with DAMAGED and FILE for each line; reading does not fail."""
    return _with_file(spark.read.schema(_marked_schema(schema)).options(**LANDING_OPTIONS).csv(paths))


def stream_landing_lines(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, archive: str | None = None
) -> DataFrame:
    """The same lines as a stream: each file is delivered once per checkpoint.

    With ``archive`` files that were delivered are moved there, under their whole path, so that
    listing takes as long as there are new ones.
    """
    reader = spark.readStream.schema(_marked_schema(schema)).options(**LANDING_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_file(reader.csv(path))
