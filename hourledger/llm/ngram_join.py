"""Near-duplicate groups by a size-aware join of shingle sets.

Every text is the set of its word shingles, hashed to 64 bits. Shingles are ordered by rarity, as a
count sketch over all documents tells it, ties by hash; any total order gives the same links. Sets of
the wanted similarity share a shingle among their first few (the inverted lists of large sets), and
share two among one more: small sets enumerate the pairs of those, keys that hardly meet by chance.
The size up to which sets count as small is the one of least cost over the sizes that occur.

Equal sets are one node. Two sets of a list are candidates if their sizes allow the similarity, and
so do their signatures: the counts of shingles by hash bin, whose sum of minima bounds the
intersection from above. Large sets have more bins, and fold them to meet smaller ones. Sets that are candidates, directly or through others, are a group; a group's
sets are scanned together. Long lists are dealt out as pairs of blocks of bounded size, large groups as
blocks, of which only what is not connected yet meets the others. Lists and scans report spanning forests, so n near copies give n - 1 rows, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.arrow import blocks, kept, ragged
from hourledger.llm.staging import staged
from hourledger.llm.words import hashed_words, mix
from hourledger.operators.reduced import join_reduced
from hourledger.session import shared_dir

#: Counters of the rarity sketch, as a power of two.
SKETCH_BITS = 18
#: Where a bin of a signature, a byte, stops counting.
FULL = 255
#: Bytes of text whose shingles are made at a time: each byte takes some fifty in passing.
TEXT_BYTES = 1 << 20
#: Shingles of a block of a candidate group; two blocks are scanned together.
BLOCK_SHINGLES = 1_000_000
#: Members of a block of a long list, and rows of short lists that are looked through together.
LIST_BLOCK, LIST_ROWS = 2048, 20_000
#: Hash bins of a signature, by powers of two: one for SHINGLES_A_BIN shingles, within these bounds. Fuller bins tell
#: unrelated sets apart less and less; a set beyond the upper bound is only filtered less.
BINS, MOST_BINS, SHINGLES_A_BIN = 128, 2048, 8
#: What a posting of an inverted list costs, in keys of a small set.
SCAN_COST = 4


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending within each, and where each text's begin.

    A text of fewer words is one shingle, a text without words is empty.
    """
    hashes, begins = hashed_words(texts)
    sizes = np.diff(begins)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = ragged(begins[:-1], counts)
    length = np.minimum(sizes, k)[owner]
    value = length.astype(np.uint64)
    for j in range(k):
        inside = length > j
        word = hashes[np.where(inside, first + j, 0)] if len(hashes) else np.zeros(0, np.uint64)
        value = np.where(inside, mix(value ^ word), value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.searchsorted(owner, np.arange(len(sizes) + 1))


def least_overlap(size: int, percent: int) -> int:
    """The fewest shingles that a set shares with any similar one."""
    return -(-size * percent // 100)


def small_boundary(histogram: dict[int, int], percent: int) -> int:
    """The largest size that counts as small, by least cost."""
    sizes = sorted(s for s in histogram if s > 0)
    spare = lambda s: s - least_overlap(s, percent)
    pairs = {s: (spare(s) + 2) * (spare(s) + 1) // 2 for s in sizes}
    best, cost = 0, None
    light = 0
    for boundary in [0, *sizes]:
        light += histogram.get(boundary, 0) * pairs.get(boundary, 0)
        heavy = sum(histogram[s] * (spare(s) + 1) * SCAN_COST for s in sizes if s >= least_overlap(boundary + 1, percent))
        if cost is None or light + heavy < cost:
            best, cost = boundary, light + heavy
        if pairs.get(boundary, 0) > 1 << 16:
            break
    return best


def bins_of(sizes: np.ndarray) -> np.ndarray:
    """How many bins the signatures of sets of these sizes have."""
    needed = np.maximum(-(-sizes // SHINGLES_A_BIN), 1)
    return np.clip(1 << np.ceil(np.log2(needed)).astype(np.int64), BINS, MOST_BINS)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _statistics(texts: DataFrame, k: int) -> tuple[np.ndarray, dict[int, int]]:
    """The rarity sketch and the sizes of all sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, sizes = np.zeros(1 << SKETCH_BITS, np.int64), {}
        kept(("ngram join",), lambda: None)  # what an earlier stage left in the worker goes
        for batch in blocks(batches, 0, TEXT_BYTES):
            value, begins = shingle_sets(batch.column(0), k)
            sketch += np.bincount((value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            for size, n in zip(*(x.tolist() for x in np.unique(np.diff(begins), return_counts=True)), strict=True):
                sizes[size] = sizes.get(size, 0) + n
        at = np.flatnonzero(sketch)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sketch[at])], ["key", "n"])
        # Sizes stand below zero.
        yield pa.RecordBatch.from_arrays([pa.array([-1 - s for s in sizes], pa.int64()), pa.array(list(sizes.values()), pa.int64())], ["key", "n"])

    found = texts.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, n = (found.column(c).to_numpy() for c in ("key", "n"))
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    sketch[keys[keys >= 0]] = n[keys >= 0]
    return sketch, dict(zip((-1 - keys[keys < 0]).tolist(), n[keys < 0].tolist(), strict=True))


def _signatures(texts: DataFrame, k: int, percent: int, sketch: np.ndarray, boundary: int) -> DataFrame:
    """id, n, f1, f2 (equal for equal sets), signature, keys of inverted lists and of pairs, of every text."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch)
    both = least_overlap(boundary + 1, percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = shared.value
        for batch in blocks(batches, 1, TEXT_BYTES):
            value, begins = shingle_sets(batch.column(1), k)
            sizes = np.diff(begins)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((value, rarity[(value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], owner))
            ranked = value[order]
            total, other = np.zeros((2, len(value) + 1), np.uint64)
            np.cumsum(mix(value), out=total[1:])
            np.cumsum(mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=other[1:])
            wide = bins_of(sizes)
            cuts = np.concatenate([[0], np.cumsum(wide)])
            bins = cuts[owner] + (mix(value ^ np.uint64(0x5A5A5A5A5A5A5A5A)).view(np.int64) & (wide[owner] - 1))
            bins = np.minimum(np.bincount(bins, minlength=cuts[-1]), FULL).astype(np.uint8)
            lists, pairs = [], []
            for size, begin in zip(sizes.tolist(), begins[:-1].tolist(), strict=True):
                first = size - least_overlap(size, percent) + 1 if size else 0
                lists.append(ranked[begin : begin + first] if size >= both else ranked[:0])
                # Two sets that differ share a second shingle only if both hold more than one.
                chosen = ranked[begin : begin + first + 1] if 1 < size <= boundary else ranked[:0]
                at = np.array(list(combinations(range(len(chosen)), 2)), np.int64).reshape(-1, 2)
                low, high = np.sort(chosen[at], axis=1).T if len(at) else (ranked[:0], ranked[:0])
                pairs.append(mix(low ^ mix(high)))
            as_lists = lambda parts: pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)), _signed(np.concatenate(parts) if parts else ranked[:0])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), _signed(total[begins[1:]] - total[begins[:-1]]), _signed(other[begins[1:]] - other[begins[:-1]]), pa.array([bins[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), as_lists(lists), as_lists(pairs)],
                ["id", "n", "f1", "f2", "bins", "lists", "pairs"],
            )

    longs = T.ArrayType(T.LongType())
    fields = [texts.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n", "f1", "f2")), T.StructField("bins", T.BinaryType()), T.StructField("lists", longs), T.StructField("pairs", longs)]
    return texts.select("id", "text").mapInArrow(sign, T.StructType(fields))


def components(edges: DataFrame) -> DataFrame:
    """node and root, its smallest reachable node, of every node of `edges` (a, b), by star contraction.

    Each round points neighbours at the smallest one; a node with many neighbours is split over
    tasks. Rounds end when nothing moves; each is written to the checkpoint folder.
    """
    shared_dir(edges.sparkSession)
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    state = None
    while True:
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours point at the smallest of all neighbours, smaller ones at the smallest of them.
        large = join_reduced(ways, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_reduced(large, lower, ["a"])
        pointed = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        edges = pointed.where("a <> b").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _forest(n: int):
    """Union-find over n places: `join` says whether two were apart."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a: int, b: int) -> bool:
        a, b = find(a), find(b)
        parent[a] = b
        return a != b

    return join


def candidates_of(sizes: np.ndarray, signatures: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and signatures allow."""
    wide = np.array([len(b) for b in signatures])
    order = np.argsort(-wide, kind="stable")
    sizes, wide = sizes[order], wide[order]
    join, found, bins = _forest(len(sizes)), [], None
    for i in range(len(sizes)):
        # Those before have as many bins or more, and are folded to as many.
        if bins is None or wide[i] != bins.shape[1]:
            own = np.frombuffer(b"".join(signatures[at] for at in order[i:][wide[i:] == wide[i]].tolist()), np.uint8).reshape(-1, wide[i])
            bins = own if bins is None else np.concatenate([_folded(bins, wide[i]), own])
        least = np.minimum(bins[i], bins[:i])
        # Two full bins may share any number.
        shared = np.where((least == FULL).any(axis=1), np.minimum(sizes[i], sizes[:i]), least.sum(axis=1, dtype=np.int64))
        near = np.flatnonzero(100 * shared >= percent * (sizes[:i] + sizes[i] - shared))
        found += [(int(order[j]), int(order[i])) for j in near.tolist() if join(i, j)]
    return found


def _folded(bins: np.ndarray, wide: int) -> np.ndarray:
    """The signatures with so many bins; a bin that was full stays full."""
    return np.minimum(bins.reshape(len(bins), -1, wide).sum(axis=1, dtype=np.int64), FULL).astype(np.uint8)


def links_of(ids: list, sizes: np.ndarray, values: np.ndarray, percent: int, asked: np.ndarray | None = None) -> list[tuple]:
    """A spanning forest of the links among the sets, or of those of the sets `asked`, by scanning inverted lists."""
    begins = np.cumsum(sizes) - sizes
    _, token = np.unique(values, return_inverse=True)
    order = np.argsort(token, kind="stable")
    held = np.repeat(np.arange(len(sizes)), sizes)[order]
    starts = np.searchsorted(token[order], np.arange(token.max() + 2))
    join, found = _forest(len(sizes)), []
    for i in range(len(sizes)) if asked is None else asked.tolist():
        others = i if asked is None else len(sizes)
        own = token[begins[i] : begins[i] + sizes[i]]
        shared = np.bincount(held[ragged(starts[own], starts[own + 1] - starts[own])], minlength=len(sizes))[:others]
        near = np.flatnonzero(100 * shared >= percent * (sizes[:others] + sizes[i] - shared))
        found += [(j, i) for j in near.tolist() if join(i, j)]
    return [(ids[a], ids[b]) for a, b in found]


def near_groups(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id of every row.

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets; a component
    is named by its smallest id. Null texts and texts without words have empty sets, linked with
    nothing. Rows that share an id
    get the smallest of their components. A row with a null id takes no part and has a null
    component. Equal shingles are told by 64-bit hashes. Other columns are not read.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    shared_dir(docs.sparkSession)
    sketch, histogram = _statistics(texts, k)
    boundary = small_boundary(histogram, percent)
    signed = staged(_signatures(texts, k, percent, sketch, boundary), "signatures")
    linkable = signed.where("id is not null and n > 0")
    # Equal sets are one node, named by the smallest id.
    nodes = linkable.groupBy("n", "f1", "f2").agg(F.min("id").alias("node"), F.first("bins").alias("bins"), F.first("lists").alias("lists"), F.first("pairs").alias("pairs"))
    nodes = staged(nodes, "nodes")
    large = nodes.select("node", "n", F.explode("lists").alias("key"), F.lit(False).alias("pair"))
    small = nodes.select("node", "n", F.explode("pairs").alias("key"), F.lit(True).alias("pair"))
    # Made anew where they are read: as rows they take several times the room of the nodes' arrays.
    postings = large.unionByName(small)
    # A list of small sets only says nothing that their pairs do not say.
    lists = postings.groupBy("key", "pair").agg(F.max("n").alias("most"), F.count("*").alias("members"))
    lists = lists.where((F.col("members") > 1) & (F.col("pair") | (F.col("most") > boundary))).select("key", "pair", "members")
    shared = staged(join_reduced(postings, lists, ["key", "pair"], "inner"), "postings")
    edges = _candidates(shared, nodes.select("node", "bins"), percent)
    groups = components(edges).withColumnRenamed("node", "id").withColumnRenamed("root", "rep_group")
    links = components(_scan(texts, nodes.select("node", "n"), groups, k, percent))
    own = join_reduced(linkable.select("id", "n", "f1", "f2"), nodes.select("node", "n", "f1", "f2"), ["n", "f1", "f2"]).select("id", "node")
    every = join_reduced(own, links, ["node"]).select("id", F.coalesce("root", "node").alias("root"))
    # Rows that share an id get the smallest of their components.
    smallest = every.groupBy("id").agg(F.min("root").alias("root"))
    return join_reduced(signed.select("id", "n"), smallest, ["id"]).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id")
    )


def _candidates(shared: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect the candidates of every list."""
    slots = max(1, shared.count() // LIST_ROWS)
    parts = F.ceil(F.col("members") / LIST_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = join_reduced(shared, signatures, ["node"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    # Short lists share a slot; each pair of blocks of a long one has its own.
    group = F.when(parts == 1, F.pmod(F.xxhash64("key", "pair"), F.lit(slots))).otherwise(F.xxhash64("key", "pair", low, high))
    dealt = dealt.select("node", "n", "bins", group.alias("slot"), F.xxhash64("key", "pair", low, high).alias("list"))

    def look(table: pa.Table) -> pa.Table:
        table = table.sort_by([("list", "ascending"), ("node", "ascending")]).combine_chunks()
        nodes, kind = table.column("node").to_pylist(), table.schema.field("node").type
        sizes = table.column("n").to_numpy()
        bins = table.column("bins").to_pylist()
        lists = table.column("list").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(lists)) + 1).tolist(), len(lists)]
        done, found = set(), []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            members = tuple(nodes[a:b])
            if members not in done:  # near copies share many lists
                done.add(members)
                found += [(members[i], members[j]) for i, j in candidates_of(sizes[a:b], bins[a:b], percent)]
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    out = T.StructType([T.StructField(c, shared.schema["node"].dataType) for c in ("a", "b")])
    return dealt.groupBy("slot").applyInArrow(look, out)


def _scan(texts: DataFrame, nodes: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) within candidate groups that connect what any links connect.

    A group's sets are dealt into blocks of bounded size, each with the group's first set, and a block is
    scanned as a whole. What links connect to the first set, as near copies mostly are, need not meet
    again. Only the sets that are left are compared with the group's other blocks.
    """
    kind = texts.schema["id"].dataType
    members = join_reduced(nodes.withColumnRenamed("node", "id"), groups, ["id"], "inner")
    totals = members.groupBy("rep_group").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    members = staged(join_reduced(members, totals, ["rep_group"]).select("id", "n", "rep_group", "blocks"), "members")

    def every(blocks: Column) -> Column:
        return F.sequence(F.lit(0), blocks - 1)

    def own(blocks: Column) -> Column:
        return F.pmod(F.xxhash64("id"), blocks).cast("int")

    def look(table: pa.Table) -> pa.Table:
        values, begins = shingle_sets(table.column("text").combine_chunks(), k)
        ids, asked = table.column("id").to_pylist(), table.column("asked").to_numpy()
        found = links_of(ids, np.diff(begins), values.view(np.int64), percent, None if asked.all() else np.flatnonzero(asked)) if len(values) else []
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    def scanned(dealt: DataFrame) -> DataFrame:
        # Texts go to their blocks as they are: they take less room than their shingles.
        rows = texts.where("id is not null").join(dealt, "id").select("id", "text", "rep_group", "i", "j", "asked")
        return rows.groupBy("rep_group", "i", "j").applyInArrow(look, T.StructType([T.StructField(c, kind) for c in ("a", "b")]))

    blocks = F.col("blocks")
    place = F.explode(F.when(F.col("id") == F.col("rep_group"), every(blocks)).otherwise(F.array(own(blocks)))).alias("i")
    first = staged(scanned(members.select("id", "rep_group", place, F.lit(0).alias("j"), F.lit(True).alias("asked"))), "links")
    split = members.where(blocks > 1)
    if split.isEmpty():
        return first
    roots = components(first).withColumnRenamed("node", "id")
    rooted = join_reduced(split, roots, ["id"]).withColumn("root", F.coalesce("root", "id"))
    leading = rooted.where(F.col("id") == F.col("rep_group")).select("rep_group", F.col("root").alias("leading"))
    left = staged(join_reduced(rooted, leading, ["rep_group"]).where(F.col("root") != F.col("leading")).select("id", "n", "rep_group", "blocks"), "left")
    waiting = left.groupBy("rep_group").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("parts"))
    parts = F.col("parts")
    one = join_reduced(left, waiting, ["rep_group"]).select("id", "rep_group", F.explode(every(blocks)).alias("i"), own(parts).alias("j"), F.lit(True).alias("asked"))
    other = join_reduced(split, waiting, ["rep_group"], "inner").select("id", "rep_group", own(blocks).alias("i"), F.explode(every(parts)).alias("j"), F.lit(False).alias("asked"))
    return first.unionByName(scanned(one.unionByName(other)))
