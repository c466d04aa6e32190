"""Joins of many rows to a frame that holds one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "__key_hash"


def join_reduced(facts: DataFrame, reduced: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to ``reduced``, the one-row-per-key result of a grouping, so that hot keys split.

    Adaptive execution splits a hot key of a sort-merge join only where both sides come straight
    from a shuffle made for the join. A reduced side is already partitioned by its key; joined as
    it is, it would switch that protection off, and a key holding a third of the facts would be
    one task. With a hash of the key as a second join column Spark shuffles the reduced side,
    which is the small one, once more, and the split applies. Where the reduced side is small
    enough Spark broadcasts it, and neither side is shuffled.

    Key types must agree: equal values of different types hash differently.
    """
    for key in keys:
        left, right = facts.schema[key].dataType, reduced.schema[key].dataType
        if left != right:
            raise TypeError(f"key {key} is {left.simpleString()} here and {right.simpleString()} there")
    key_hash = F.xxhash64(*keys)
    joined = facts.withColumn(_HASH, key_hash).join(
        reduced.withColumn(_HASH, key_hash), [*keys, _HASH], how
    )
    columns = [*facts.columns, *(name for name in reduced.columns if name not in keys)]
    return joined.select(*(facts.columns if how in ("left_semi", "left_anti") else columns))
