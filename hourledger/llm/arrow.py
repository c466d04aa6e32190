"""Helpers for functions that run inside Spark tasks on Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at a time; only a single longer text exceeds it.
BLOCK_BYTES = 4 << 20
#: Bytes of rows that Spark hands a Python worker at a time; only a single longer row exceeds it by more.
BATCH_BYTES = 8 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on this session's batches are bounded in bytes, unless the user has bounded them.

    Spark by itself sends 10,000 rows at once, of whatever size, and the executor holds such a batch
    as vectors, as a message and in the worker. The limit is read when a result is computed, so it
    is not taken back here.
    """
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def kept(key: tuple, build: Callable):
    """What `build` makes, kept for the life of the Python worker."""
    module = sys.modules.setdefault("_hourledger_worker", types.ModuleType("_hourledger_worker"))
    store = module.__dict__.setdefault("store", {})
    if key not in store:
        # One model at a time: a worker that serves many jobs must not pile them up.
        store.clear()
        store[key] = build()
    return store[key]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last ends; a null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: int, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... lengths[0] of them, then the same from starts[1], and so on."""
    total = int(lengths.sum())
    begins = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - begins, lengths)


def map_texts(
    docs: DataFrame,
    text: str,
    carry: list[str],
    outputs: dict[str, str],
    start: Callable[[], Callable[[pa.Array], list]],
    size: int = BLOCK_BYTES,
) -> DataFrame:
    """The carried columns and `outputs` (name to type) of every row.

    `start` is called once a task and returns what makes the output columns from a column of texts.
    Only the carried columns and the text are read. An output named like a carried column is an error.
    """
    if clash := set(carry) & set(outputs):
        raise ValueError(f"columns {sorted(clash)} would be there twice; use a prefix")
    columns = list(dict.fromkeys([*carry, text]))
    schema = T.StructType([docs.schema[c] for c in carry])
    for name, kind in outputs.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        at = columns.index(text)
        for batch in blocks(batches, at, size):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(batch.column(at))]
            kept_columns = [batch.column(columns.index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept_columns, *made], [*carry, *outputs])

    return docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def held_out(id_col: str, parts: int, part: int):
    """Whether crc32 of the id's text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % parts == part, F.lit(False))


def to_learn_from(id_col: str, parts: int, part: int):
    """Whether a row is not held out; a null id is never learned from."""
    return F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col, parts, part)
