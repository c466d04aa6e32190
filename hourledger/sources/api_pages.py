"""Landed API pages: ``{"data": [...], "meta": {"totalRows": n}}``, one page per line or file."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger import files, schemas
from hourledger.functions import convert
from hourledger.session import shared_dir


class IncompletePages(RuntimeError):
    """The pages do not add up to the announced number of rows."""


class UnreadableValues(RuntimeError):
    """Numbers or flags of the pages cannot be read."""


def _items(schema: T.StructType) -> T.StructType:
    return schema["data"].dataType.elementType


def _numbers(schema: T.StructType) -> list[T.StructField]:
    """The fields of an item that are not text."""
    return [field for field in _items(schema) if not isinstance(field.dataType, T.StringType)]


def _read_text(spark: SparkSession, path: str, items: T.StructType, multi_line: bool) -> DataFrame:
    """Pages with every field of their items as text, whatever its type in JSON."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in items.names])
    return (
        spark.read.schema(schemas.page_of(text))
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(multi_line).lower())
        .json(path)
    )


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value
    return convert.to_flag(value) if isinstance(kind, T.IntegerType) else convert.to_number(value)


def _parse(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Typed pages, and for each how many values of each number or flag cannot be read."""
    pages, fields = _read_text(spark, path, _items(schema), multi_line), _items(schema)

    def typed(item: Column) -> Column:
        return F.when(item.isNotNull(), F.struct(*(_typed(item[f.name], f.dataType).alias(f.name) for f in fields)))

    def lost(field: T.StructField) -> Column:
        bad = F.filter("data", lambda item: item[field.name].isNotNull() & _typed(item[field.name], field.dataType).isNull())
        return F.coalesce(F.size(bad), F.lit(0)).alias(field.name)

    unreadable = F.struct(F.lit(0).alias("none"), *(lost(field) for field in _numbers(schema)))
    data = F.transform("data", typed) if _numbers(schema) else F.col("data")
    return pages.select(data.alias("data"), "meta", unreadable.alias("unreadable"))


def read_pages(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Pages under ``path``. ``multi_line`` is for pretty-printed pages, one file each.

    Numbers and flags may be sent as text; one that cannot be read is NULL here and fails `read_complete_pages`.
    """
    return _parse(spark, path, schema, multi_line).drop("unreadable")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per item of ``data``."""
    return pages.select(F.explode("data").alias("item")).select("item.*")


def flatten_entries(pages: DataFrame) -> DataFrame:
    """Time entries, with ``date`` typed and named ``entry_date``."""
    return flatten_pages(pages).withColumn("entry_date", convert.to_day(F.col("date"))).drop("date")


def page_totals(pages: DataFrame) -> DataFrame:
    """One row: rows delivered, rows announced, and whether they agree. Unreadable pages count 0.

    They agree if every page announces the same number and so many different ids were delivered:
    a repeated page must not make up for a missing one, nor a page that announces nothing for one
    that does. Items without an id count as different.
    """
    # The ids alone, so that pages kept as Parquet are read for these only.
    items = pages.select(F.col("meta.totalRows").alias("total"), F.posexplode_outer("data.id").alias("pos", "id"))
    counts = items.agg(
        F.count("pos").alias("delivered"),
        F.coalesce(F.max("total"), F.lit(0)).alias("announced"),
        F.coalesce(F.min("total"), F.lit(0)).alias("least"),
        F.count_if(F.col("total").isNull()).alias("silent"),
        (F.count_distinct("id") + F.count("pos") - F.count("id")).alias("ids"),
    )
    agree = (F.col("delivered") == F.col("announced")) & (F.col("ids") == F.col("announced"))
    agree = agree & (F.col("least") == F.col("announced")) & (F.col("silent") == 0)
    return counts.select("delivered", "announced", agree.alias("complete"))


def require_complete(pages: DataFrame) -> None:
    """Fail the load when pages are missing, were landed twice or do not say how many rows there are."""
    totals = page_totals(pages).first()
    if not totals["complete"]:
        raise IncompletePages(
            f"{totals['delivered']} rows in the pages, {totals['announced']} announced, or not by every page, or ids repeated"
        )


def _require_readable(pages: DataFrame) -> None:
    names = pages.schema["unreadable"].dataType.names
    found = pages.agg(*(F.sum(f"unreadable.{name}").alias(name) for name in names)).first()
    if lost := {name: found[name] for name in names if found[name]}:
        raise UnreadableValues(", ".join(f"{n} unreadable values of {name}" for name, n in lost.items()))


def read_complete_pages(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, kept: str | None = None
) -> DataFrame:
    """Pages under ``path``, once their rows are known to add up and their numbers and flags to be readable.

    The JSON is parsed once, into typed pages under ``kept``, which the caller deletes, or in the shared
    folder until the application ends. The checks read ids and counts from there, and the result is
    those pages, whatever happens to the dump meanwhile.
    """
    folder = kept or f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}"
    if not kept:
        files.delete_at_end(spark, folder)
    parsed = _parse(spark, path, schema, multi_line)
    parsed.write.parquet(folder)
    pages = spark.read.schema(parsed.schema).parquet(folder)
    require_complete(pages)
    _require_readable(pages)
    return pages.drop("unreadable")
