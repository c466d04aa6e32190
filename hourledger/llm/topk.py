"""Exact top-k inner products by pivot-table elimination.

Every vector carries its distances to many pivots. A block's candidates are dealt into cells by their
nearest pivot, and a cell has the range of its distances to each pivot. For a query and a cell the
largest gap between the query's distance and such a range is a lower bound of their distance, and with
the norms an upper bound of their inner products. Cells are evaluated in the order of this bound until
the k-th best score exceeds the next one, which is exact; one matrix product evaluates a cell for all
queries that still ask for it. Rows are dealt into blocks by a hash of their id and every block of
queries meets every block of candidates, so a task holds two blocks at a time, however many rows there
are or however often a vector repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOTS = 32
#: Rows in a block of candidates and in a block of queries, about.
CANDIDATES, QUERIES = 16384, 16384
#: Queries worked on at a time.
BATCH = 512
#: Products of norms up to which doubles and 64-bit integers hold every inner product exactly.
EXACT, LONG = float(1 << 53), float(1 << 62)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers as a matrix; a shorter row is padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    result = np.zeros((len(column), int(lengths.max(initial=0))))
    result[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(int)] = values
    return result


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    wide = max(rows.shape[1], pivots.shape[1])
    rows, pivots = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (rows, pivots))
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(rows), 0))


def products(q: np.ndarray, c: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products of rows of integers whose norms have at most the product `size`, those beyond 64 bits as the nearest within."""
    if size < EXACT:
        return q @ c.T
    if size < LONG:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    least, most = -(1 << 63), (1 << 63) - 1
    return np.vectorize(lambda x: min(max(x, least), most), otypes=[np.int64])(whole(q) @ whole(c).T)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores in a row, as integers if either are."""
    return np.concatenate([a, b] if a.dtype == b.dtype else [a.astype(np.int64), b.astype(np.int64)])


def cells_of(c: np.ndarray, c_far: np.ndarray) -> list[np.ndarray]:
    """Places of the candidates of each cell: those nearest to one pivot."""
    nearest = c_far.argmin(axis=1) if c_far.shape[1] else np.zeros(len(c), int)
    order = np.argsort(nearest, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1) if len(c) else []


def keep_best(row, at, score, ids, k: int):
    """The k best of each row, ties to the smaller id: their rows, places and scores, in order."""
    # ~score falls as score rises, also at the ends of 64 bits.
    order = np.lexsort((ids[at], ~score if score.dtype == np.int64 else -score, row))
    row, at, score = row[order], at[order], score[order]
    begins = np.searchsorted(row, row, "left")
    first = np.arange(len(row)) - begins < k
    return row[first], at[first], score[first]


def best(q_ids, q, q_far, c_ids, c, c_far, k: int):
    """Index of the query, id and score of each query's k best candidates."""
    wide = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (q, c))
    q_norm, c_norm = (np.sqrt((x**2).sum(axis=1)) for x in (q, c))
    # Large vectors stand apart: their products take slower numbers.
    large = c_norm >= np.sqrt(EXACT) / 2
    cells = [part for places in (np.flatnonzero(~large), np.flatnonzero(large)) for part in (places[x] for x in cells_of(c[places], c_far[places]))]
    low, high = (np.array([f(c_far[x], axis=0) for x in cells]).reshape(len(cells), -1) for f in (np.min, np.max))
    longest = np.array([c_norm[x].max() for x in cells])
    groups = [x for x in (np.flatnonzero(q_norm < np.sqrt(EXACT) / 2), np.flatnonzero(q_norm >= np.sqrt(EXACT) / 2)) if len(x)]
    for part in (group[a : a + BATCH] for group in groups for a in range(0, len(group), BATCH)):
        gap = np.zeros((len(part), len(cells)))
        for p in range(q_far.shape[1]):
            own = q_far[part, p, None]
            np.maximum(gap, np.maximum(low[:, p] - own, own - high[:, p]), out=gap)
        # |q - c| >= gap and |c| <= longest; rounding may take a little of either.
        norm = q_norm[part, None]
        with np.errstate(all="ignore"):
            bound = np.minimum((norm**2 + longest**2 - gap**2) / 2, norm * longest) + 1e-9 * (norm**2 + longest**2) + 0.5
        bound = np.where(np.isnan(bound), np.inf, bound)
        row, at = np.zeros((2, 0), int)
        score, least = np.zeros(0), np.full(len(part), -np.inf)
        # The cell that the queries hope most of goes first.
        for cell in np.argsort(-bound.max(axis=0), kind="stable").tolist():
            asks = np.flatnonzero(bound[:, cell] >= least)
            if not len(asks):
                continue
            own = cells[cell]
            found = products(q[part[asks]], c[own], float(q_norm[part].max() * longest[cell]))
            other = q_ids[part[asks], None] != c_ids[None, own]
            hit = other & (found >= least[asks, None])
            if len(own) > k and found.dtype == np.float64:
                # A cell's own k best are enough, and those that tie with them.
                alike = np.where(other, found, -np.inf)
                hit &= found >= np.partition(alike, len(own) - k, axis=1)[:, len(own) - k, None]
            new_row, new_at = np.nonzero(hit)
            score = joined(score, found[new_row, new_at])
            row, at = np.concatenate([row, asks[new_row]]), np.concatenate([at, own[new_at]])
            row, at, score = keep_best(row, at, score, c_ids, k)
            full = np.flatnonzero(np.bincount(row, minlength=len(part)) == k)
            last = np.searchsorted(row, full, "right") - 1
            kth = score[last].astype(np.float64)
            # Long integers are rounded as doubles.
            least[full] = kth if score.dtype == np.float64 else kth - 1e-15 * np.abs(kth)
        yield part[row], c_ids[at], score.astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest inner products of floor(scale * x).

    A query is every row of `is_query`; all rows but those of its own id are candidates. Ties go to
    the smaller id. Rows whose id or vector is null, or whose vector holds null or non-finite
    components, take no part. A shorter vector counts as padded with zeros, an empty one as all
    zeros. Rows that repeat an id are candidates each, and as queries count once. Fewer than k
    candidates give fewer rows, an empty table none. Scores are exact, however large the components;
    one beyond 64 bits counts as the nearest such number.
    """
    x = F.col("v")
    rows = (
        vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("query"))
        .where("id is not null and v is not null")
        .where(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
        .select("id", F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v"), F.coalesce("query", F.lit(False)).alias("query"))
    )
    n, asked = rows.agg(F.count("*"), F.count_if("query")).first()
    c_blocks, q_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-asked // QUERIES))
    # A fixed number of pivots, far from each other by chance.
    pivots = [r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()]
    table = matrix(pa.array(pivots, pa.list_(pa.float64())))

    def add_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(matrix(batch.column("v")), table)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(far), pa.list_(pa.float64()))], [*batch.schema.names, "far"])

    schema = T.StructType([*rows.schema.fields, T.StructField("far", T.ArrayType(T.DoubleType()))])
    known = rows.mapInArrow(add_distances, schema)
    block = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = known.select("id", "v", "far", block(c_blocks).alias("c"), every(q_blocks).alias("q"))
    queries = known.where("query").dropDuplicates(["id"]).select("id", "v", "far", block(q_blocks).alias("q"), every(c_blocks).alias("c"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("id")
        sides = [(t.column("id").to_numpy(), matrix(t.column("v")), matrix(t.column("far"))) for t in (right, left)]
        found = list(best(*sides[0], *sides[1], k)) if len(left) and len(right) else []
        ids, others, scores = (np.concatenate([f[i] for f in found] or [[]]).astype(np.int64) for i in range(3))
        return pa.table({"query_id": sides[0][0][ids] if len(ids) else ids, "vec_id": others, "score": scores})

    pairs = candidates.groupBy("c", "q").cogroup(queries.groupBy("c", "q")).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
