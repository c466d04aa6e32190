"""Results that several later steps read, kept as Parquet in the shared folder until the application ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourledger.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors reach; it goes when the application ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and reread; later steps do not repeat the work, whoever is lost."""
    folder = f"{scratch(df.sparkSession, name)}/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
