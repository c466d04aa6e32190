"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is 13 consecutive words of a benchmark item, or the whole item if it is shorter. A document
holds a window's words in order only if it holds all of them, so the necessary prefix of a window,
its words ordered by rarity over all documents, is its rarest word. Documents join on that word
alone; the word's place in the window bounds where the window may begin and end (length and
positional bounds), and the surviving places are compared word by word over the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Windows up to this number are broadcast, some 300 bytes each; more are joined by a shuffle.
MAX_BROADCAST = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what stands between words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def item_windows(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows and the items that hold them."""
    own = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))).alias("s")
    windows = own.select("item", "w", starts).select("item", F.slice("w", F.col("s"), F.lit(size)).alias("window"))
    return windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, items: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Where documents hold windows: k1, k2 (the document's key), start (from 1), length, items.

    The key is made of id and text, so rows that repeat both share their hits.
    """
    windows = item_windows(items, size, item_id, item_text)
    own = _keyed(docs, id_col, text_col)
    few = windows.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    small = F.broadcast if few else lambda frame: frame
    # Rarity of the windows' words over all documents; words that no document holds come first.
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    frequency = own.select(F.explode("words").alias("word")).join(small(vocabulary), "word").groupBy("word").count()
    ranked = windows.select("window", "items", F.posexplode("window").alias("offset", "word")).join(frequency, "word", "left")
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "offset")).alias("rarest")
    # A window with a word of no document occurs nowhere.
    anchors = ranked.groupBy("window").agg(rarest, F.first("items").alias("items")).where("rarest.count > 0")
    anchors = anchors.select("window", "items", F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset"), F.size("window").alias("length"))
    begin = (F.col("pos") - F.col("offset") + 1).alias("start")
    inside = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("length") <= F.col("n"))
    if few:
        # The words stay beside the places they are taken from, in one pass without a shuffle.
        places = own.select("k1", "k2", "words", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
        found = places.join(F.broadcast(anchors), "word").where(inside).select("k1", "k2", "words", begin, "length", "window", "items")
    else:
        places = own.select("k1", "k2", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
        found = places.join(anchors, "word").where(inside).select("k1", "k2", begin, "length", "window", "items").distinct()
        found = found.join(own.dropDuplicates(["k1", "k2"]), ["k1", "k2"])
    same = F.slice("words", F.col("start"), F.col("length")) == F.col("window")
    return found.where(same).select("k1", "k2", "start", "length", "items")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(F.xxhash64(id_, text).alias("k1"), F.hash(text, id_).alias("k2"), words(text).alias("words"), *more)


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", carry: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The carried columns (the id) of every row, n_words, n_hit, n_items, items_sha256, contaminated, and the item ids.

    A word inside any occurrence of a window is hit; a document is contaminated if share * n_hit >=
    n_words and a word is hit. Null and empty texts have no words; items without words have no
    windows. Every row gives a row, repeated ones too; extra columns are not read.
    """
    places = hits(docs, items, size, id_col, text_col, item_id, item_text)
    # Length of the union of a document's hits: what each adds to those that begin before it.
    before = Window.partitionBy("k1", "k2").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length") - 1
    distinct = places.groupBy("k1", "k2", "start", "length").agg(F.flatten(F.collect_set("items")).alias("items"))
    adds = F.greatest(F.lit(0), end - F.greatest(F.col("start") - 1, F.coalesce(F.max(end).over(before), F.lit(0))))
    counted = distinct.withColumn("adds", adds).groupBy("k1", "k2").agg(
        F.sum("adds").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    carried = F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]]).alias("row")
    rows = _keyed(docs, id_col, text_col, carried).select("k1", "k2", "row", F.size("words").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    found = F.coalesce("items", F.array().cast("array<string>"))
    outputs = {
        "n_words": F.col("n_words"),
        "n_hit": n_hit,
        "n_items": F.size(found).cast("long"),
        "items_sha256": F.sha2(F.array_join(found, ","), 256),
        "contaminated": (n_hit > 0) & (n_hit * share >= F.col("n_words")),
        "items": found,
    }
    return rows.join(counted, ["k1", "k2"], "left").select("row.*", *[v.alias(prefix + k) for k, v in outputs.items()])
