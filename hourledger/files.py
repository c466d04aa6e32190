"""Folders on whatever file system a path names, through Hadoop's client."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_OPEN_COST = "spark.sql.files.openCostInBytes"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What opening a small file counts as, in bytes: thousands of them share a task.
SMALL_FILE = 32 << 10


@contextmanager
def listed_by_cores(spark: SparkSession) -> Iterator[None]:
    """List many folders by a few tasks a core. Spark's own choice is a task for each folder, which
    for folders of a few files costs ten times the listing."""
    usual = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTERS, usual)


@contextmanager
def read_by_cores(spark: SparkSession) -> Iterator[None]:
    """Read many small files by a few tasks a core, in what is run meanwhile. As Spark counts it, opening a
    file is worth 4 MB, and 32 files make a task, which costs more than reading them."""
    usual = spark.conf.get(_OPEN_COST)
    spark.conf.set(_OPEN_COST, str(SMALL_FILE))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_COST, usual)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what is run meanwhile when it is done. Else they stay until the driver
    happens to collect its garbage."""
    usual = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, usual)


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark names the files under it."""
    folder, files = _open(spark, path)
    return files.makeQualified(folder).toString()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return []
    return sorted(item.getPath().getName() for item in files.listStatus(folder) if item.isFile())


def has_file(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a file of that name ending is anywhere under ``path``; stops at the first."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return False
    found = files.listFiles(folder, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return []
    return sorted(item.getPath().getName() for item in files.listStatus(folder) if item.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _open(spark, path)
    return files.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _open(spark, path)
    files.delete(folder, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, under a folder that is there."""
    folder, files = _open(spark, path)
    if not files.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} cannot be moved to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _open(spark, path)
    files.mkdirs(folder)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder, there already or not, when the application ends."""
    folder, files = _open(spark, path)
    files.mkdirs(folder.getParent())
    files.deleteOnExit(folder)
