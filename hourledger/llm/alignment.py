"""Alignment of two tokenizers by divide and conquer at shared cuts.

Both tokenizers encode the same bytes. A byte offset where a token of each ends is a cut. An interval
of tokens, at first a whole document, is cut at the shared end nearest its middle, found by bisecting
the other side's ends for those around the middle, ever further from it; both halves go on alike, and
an interval without a shared end inside is a group. All intervals of a level are worked on at once.

Token pairs that overlap are links. Their counts over the corpus are asked for by block, not by
document: a task names each different pair of a block of texts once, the counts of all blocks are
summed by pair, and the answers go back to the blocks. So nothing grows with the number of pairs but
shuffled rows, and nothing is broadcast but the two tokenizers' files.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.arrow import blocks, kept, ragged
from hourledger.llm.bpe import byte_symbols
from hourledger.llm.staging import staged

#: Bytes of text in a block; a longer text is a block by itself.
BLOCK = 2 << 20
#: Bytes of different chunks of text that a worker remembers; beyond, it begins anew.
REMEMBER = 4 << 20
#: Characters of new chunks that the libraries get as one text, and texts in one call: each token of a call takes some hundred bytes.
JOINED, TOGETHER = 4096, 32
SPACE = "▁"
#: Whatever any of the libraries may take for white, and a bit more: a text is cut before a space only where none of it stands before.
WHITE = r"\s\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
CUT = re.compile(f"(?<=[^{WHITE}])(?= )")
LOOSE = re.compile(f"[{WHITE}] ")
WHITE_END = re.compile(rf"[{WHITE}]\Z")


def chunks_of(text: str) -> list[str]:
    """The text in parts that either tokenizer encodes apart as it does together; each begins with a space."""
    text = " " + text
    if LOOSE.search(text):
        return CUT.split(text)
    return [" " + part for part in text[1:].split(" ")]


def _slices(groups: list) -> Iterator[list]:
    for at in range(0, len(groups), TOGETHER):
        yield groups[at : at + TOGETHER]


class Encoders:
    """Both tokenizers' ids and bytes, remembered by chunk of text."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("a piece goes on after a space, so texts cannot be cut at spaces")
        self.space = self.b.piece_to_id(SPACE)
        byte_of = {symbol: i for i, symbol in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            a_bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.bytes = (a_bytes, b_bytes)
        self.lengths = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = ([np.zeros(0, np.int32)], [np.zeros(0, np.int32)]), ([np.zeros(1, np.int64)], [np.zeros(1, np.int64)])
        self.same, self.total, self.size = [np.zeros(0, bool)], [0, 0], 0

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks, many together where they may stand in one text."""
        joined, alone, size = [[]], [], 0
        for chunk in chunks:
            self.size += len(chunk)
            if chunk == " " or WHITE_END.search(chunk):
                alone.append([chunk])
                continue
            if size > JOINED:
                joined.append([])
                size = 0
            joined[-1].append(chunk)
            size += len(chunk)
        failed = [group for some in _slices([group for group in joined if group]) for group in self._learn(some)]
        for some in _slices([*alone, *([chunk] for group in failed for chunk in group)]):
            self._learn(some)

    def _learn(self, groups: list[list[str]]) -> list[list[str]]:
        """Encode each group as one text; gives back those of several chunks that are not what their tokens' bytes make."""
        texts = ["".join(group) for group in groups]
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)] if texts else []
        b = self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []
        failed = []
        for group, text, *sides in zip(groups, texts, a, b, strict=True):
            # The library adds the space before a text, but not before an empty one.
            sides = [np.array(ids or [self.space], np.int32) for ids in sides]
            data = text.encode()
            same = all(b"".join([names[i] for i in ids.tolist()]) == data for names, ids in zip(self.bytes, sides, strict=True))
            if not same and len(group) > 1:
                failed.append(group)
                continue
            ends = np.cumsum([len(chunk.encode()) for chunk in group])
            self.known.update(zip(group, range(len(self.known), len(self.known) + len(group)), strict=True))
            self.same.append(np.full(len(group), same))
            for side, ids in enumerate(sides):
                self.flat[side].append(ids)
                at = np.searchsorted(np.cumsum(self.lengths[side][ids]), ends) + 1 if same else np.array([len(ids)])
                self.starts[side].append(at + self.total[side])
                self.total[side] += len(ids)
        return failed

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each tokenizer all ids in a row, and where each text's ids begin and the last end.

        A text that is null, empty or not what its tokens' bytes make has none.
        """
        parts = [chunks_of(text) if text else [] for text in texts]
        if self.size > REMEMBER:
            self.forget()
        new = list(set().union(*parts).difference(self.known))
        if new:
            self.learn(new)
            self.same = [np.concatenate(self.same)]
            self.flat, self.starts = (tuple([np.concatenate(x)] for x in sides) for sides in (self.flat, self.starts))
        chunk = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        good = np.ones(len(parts), bool)
        good[owner[~self.same[0][chunk]]] = False
        chunk, owner = chunk[good[owner]], owner[good[owner]]
        result = []
        for (flat,), (starts,) in zip(self.flat, self.starts, strict=True):
            lengths = starts[chunk + 1] - starts[chunk]
            begins = np.concatenate([[0], np.cumsum(np.bincount(owner, lengths, len(parts)).astype(np.int64))])
            result.append((flat[ragged(starts[chunk], lengths)], begins))
        return result


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, begins_a: np.ndarray, begins_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as a number of tokens of each side, in order.

    `ends` are the byte offsets at which tokens end, `begins` where each text's tokens begin and the
    last end. Texts have the same bytes on both sides and end at a shared cut.
    """
    some = (np.diff(begins_a) > 0) & (np.diff(begins_b) > 0)
    lo_a, hi_a, lo_b, hi_b = begins_a[:-1][some], begins_a[1:][some], begins_b[:-1][some], begins_b[1:][some]
    cuts_a, cuts_b = [hi_a], [hi_b]
    while True:
        # One token on a side leaves no room for a cut.
        wide = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = (x[wide] for x in (lo_a, hi_a, lo_b, hi_b))
        if not len(lo_a):
            break
        middle, last = (lo_a + hi_a - 1) // 2, hi_a - 2
        cut_a, cut_b = np.full(len(lo_a), -1), np.zeros(len(lo_a), np.int64)
        open_, reach = np.arange(len(lo_a)), 0
        while len(open_):
            first = np.maximum(lo_a[open_], middle[open_] - reach)
            count = np.minimum(last[open_], middle[open_] + reach) - first + 1
            owner = np.repeat(np.arange(len(open_)), count)
            at = ragged(first, count)
            other = np.searchsorted(ends_b, ends_a[at])
            fits = ends_b[other] == ends_a[at]
            owner, at, other = owner[fits], at[fits], other[fits]
            away = np.abs(at - middle[open_[owner]])
            # The nearest of each interval is written last; of two as near the right one stays.
            nearest = np.lexsort((at, -away)) if reach else np.arange(len(at))
            cut_a[open_[owner[nearest]]], cut_b[open_[owner[nearest]]] = at[nearest], other[nearest]
            whole = (first == lo_a[open_]) & (first + count - 1 == last[open_])
            open_ = open_[(cut_a[open_] < 0) & ~whole]
            reach = max(1, reach * 4)
        split = cut_a >= 0
        lo_a, hi_a, lo_b, hi_b, cut_a, cut_b = (x[split] for x in (lo_a, hi_a, lo_b, hi_b, cut_a + 1, cut_b + 1))
        cuts_a.append(cut_a)
        cuts_b.append(cut_b)
        halves = lambda x, y: np.stack([x, y], axis=1).ravel()
        lo_a, hi_a, lo_b, hi_b = halves(lo_a, cut_a), halves(cut_a, hi_a), halves(lo_b, cut_b), halves(cut_b, hi_b)
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def links(ends_a: np.ndarray, ends_b: np.ndarray, lengths_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens whose byte ranges overlap, in order."""
    first = np.searchsorted(ends_b, ends_a - lengths_a, "right")
    count = np.searchsorted(ends_b, ends_a, "left") + 1 - first
    return np.repeat(np.arange(len(ends_a)), count), ragged(first, count)


@lru_cache(2)
def _written(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each followed by one of the marks that may come after it, padded with zero bytes; and their lengths."""
    digits = np.char.mod(b"%d", np.arange(size))
    words = np.stack([np.char.add(digits, mark) for mark in (b",", b"|", b";")], axis=1).ravel()
    return words, np.char.str_len(words).astype(np.int64)


def write_groups(ids_a, ids_b, cuts_a, cuts_b, ends: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each text; `ends` are the numbers of groups at which texts end."""
    size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    begins = np.cumsum(size_a + size_b) - size_a - size_b
    size = int(max(ids_a.max(initial=0), ids_b.max(initial=0))) + 1
    marked = np.zeros(len(ids_a) + len(ids_b), np.int64)
    code_a, code_b = ids_a.astype(np.int64) * 3, ids_b.astype(np.int64) * 3
    code_a[cuts_a - 1] += 1
    code_b[cuts_b - 1] += 2
    marked[ragged(begins, size_a)] = code_a
    marked[ragged(begins + size_a, size_b)] = code_b
    words, lengths = (x[marked] for x in _written(1 << max(16, size.bit_length())))
    data = words.view(np.uint8)
    data = data[data != 0].tobytes()
    tokens = np.concatenate([[0], np.cumsum(size_a + size_b)])[ends]
    at = np.concatenate([[0], np.cumsum(lengths)])[tokens].tolist()
    # Without the mark after the last group.
    return [data[a : b - 1] if b > a else b"" for a, b in zip([0, *at], at, strict=False)]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 to 2**35 in seven bits a byte, low ones first, and the bytes of each."""
    sizes = 1 + sum((values >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    place = ragged(np.zeros(len(values), np.int64), sizes)
    data = (np.repeat(values, sizes) >> (7 * place)) & 127
    data[place < np.repeat(sizes - 1, sizes)] |= 128
    return data.astype(np.uint8), sizes


def unpack(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


def _cells(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A cell of bytes for each of the ends."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _align(texts: list[str | None], encoders: Encoders) -> dict:
    """What the documents of a block have: numbers, groups, and packed different links with their times."""
    n = len(texts)
    (ids_a, begins_a), (ids_b, begins_b) = encoders.encode(texts)
    lengths_a = encoders.lengths[0][ids_a]
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(encoders.lengths[1][ids_b])
    cuts_a, cuts_b = shared_cuts(ends_a, ends_b, begins_a, begins_b)
    group_ends = np.searchsorted(cuts_a, begins_a[1:], "right")
    a, b = links(ends_a, ends_b, lengths_a)
    owner = np.searchsorted(begins_a, a, "right") - 1
    pieces = len(encoders.lengths[1])
    pairs = pieces * len(encoders.lengths[0])
    code, times = np.unique(owner * pairs + ids_a[a].astype(np.int64) * pieces + ids_b[b], return_counts=True)
    owner, distinct = code // pairs, code % pairs
    code, which, docs = np.unique(distinct, return_inverse=True, return_counts=True)
    # Numbers rise within a document, so their differences are small.
    steps = np.diff(which, prepend=0)
    fresh = np.searchsorted(owner, np.arange(n))
    fresh = fresh[fresh < len(owner)]
    steps[fresh] = which[fresh]
    ends = np.searchsorted(owner, np.arange(1, n + 1))
    cells = []
    for values in (steps, times):
        data, sizes = pack(values)
        cells.append(_cells(data, np.concatenate([[0], np.cumsum(sizes)])[ends]))
    return {
        "n_a": np.diff(begins_a), "n_b": np.diff(begins_b), "n_groups": np.diff(group_ends, prepend=0), "n_links": np.diff(np.searchsorted(a, begins_a)),
        "groups": write_groups(ids_a, ids_b, cuts_a, cuts_b, group_ends), "links": cells[0], "times": cells[1], "pairs": code, "docs": docs,
    }


def _counted(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """n_best and count_sum of the documents of a block, from the counts of its pairs."""
    place = right.column("place").to_numpy()
    count, best = (np.zeros(int(place.max(initial=-1)) + 1, np.int64) for _ in range(2))
    count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy()
    n_best, total = [], []
    for links_, times in zip(left.column("links"), left.column("times"), strict=True):
        which = np.cumsum(unpack(np.frombuffer(links_.as_py(), np.uint8)))
        often = unpack(np.frombuffer(times.as_py(), np.uint8))
        n_best.append(int(best[which] @ often))
        total.append(int(count[which] @ often))
    return np.array(n_best, np.int64), np.array(total, np.int64)


def align_tokens(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = "", digest: bool = False
) -> DataFrame:
    """The carried columns (the id) and the alignment of each text's tokens under two tokenizers.

    `byte_level` is the path of a byte-level tokenizer file (A), which gets a space and the text, and
    `pieces` that of a sentence-piece model (B), which adds the space itself. Columns: n_a and n_b
    tokens, n_groups, n_links; n_best, the links whose count is the highest of their A id, ties
    included; count_sum over all links; groups, as `a1,a2|b1;a3|b2,b3`. The count of an id pair is the
    number of rows that hold it linked. With `digest`, groups_sha256 stands in place of groups, and is
    empty where there are no tokens.

    A text that is null, empty or other than its tokens' bytes has zeros and no groups. Special tokens
    in a text are plain text. Every row gives a row and is a document of its own, also with a null or
    repeated id; an empty table gives none. Other columns are not read. A text is worked on whole, so
    the longest one bounds a task's memory from below.
    """
    spark = docs.sparkSession
    carry = carry or [id_col]
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    shown = "groups_sha256" if digest else "groups"
    outputs = [f"{prefix}{c}" for c in (*numbers, "n_best", "count_sum", shown)]
    if clash := set(carry) & set(outputs):
        raise ValueError(f"columns {sorted(clash)} would be there twice; use a prefix")
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    # Own names, so that carried columns may be called anything.
    given = [f"carry_{i}" for i in range(len(carry))]
    texts = docs.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(carry, given, strict=True)], F.col(f"`{text_col}`").alias("text"))
    fields = [T.StructField(c, T.LongType()) for c in numbers] + [T.StructField(shown, T.StringType())]
    fields += [T.StructField("block", T.LongType()), T.StructField("links", T.BinaryType()), T.StructField("times", T.BinaryType())]
    fields += [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "docs")]
    schema = T.StructType([*(texts.schema[g] for g in given), *fields])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = kept(("align", byte_level, pieces), lambda: Encoders(*files.value))
        for batch in blocks(batches, len(given), BLOCK):
            made = _align(batch.column(len(given)).to_pylist(), encoders)
            groups = made["groups"]
            written = [hashlib.sha256(g).hexdigest() if g else "" for g in groups] if digest else [g.decode() for g in groups]
            n = batch.num_rows
            # The block's pairs stand in its first row.
            once = [pa.array([made[c].tolist(), *[None] * (n - 1)], pa.list_(pa.int64())) for c in ("pairs", "docs")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(given)], *(pa.array(made[c].astype(np.int64)) for c in numbers), pa.array(written, pa.string()),
                 pa.array(np.full(n, uuid.uuid4().int >> 65)), made["links"], made["times"], *once],
                schema.names,
            )

    encoded = staged(texts.mapInArrow(align, schema), "alignment")
    asked = encoded.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x")).select(F.col("block").alias("asker"), "place", "x.pairs", "x.docs")
    sums = asked.groupBy("pairs").agg(F.sum("docs").alias("count"))
    # The pairs of one A id are no more than the pieces of B.
    own = F.expr(f"pairs div {_pieces(files.value[1])}")
    counts = sums.withColumn("best", (F.col("count") == F.max("count").over(Window.partitionBy(own))).cast("long"))
    answers = asked.join(counts, "pairs").select("asker", "place", "count", "best")
    rows = encoded.select(*given, *numbers, shown, "block", "links", "times")
    final = T.StructType([*(texts.schema[g] for g in given), *fields[:5], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        n_best, total = _counted(left, right)
        return pa.table([*(left.column(c) for c in (*given, *numbers, shown)), pa.array(n_best), pa.array(total)], names=final.names)

    done = rows.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(count, final)
    return done.select(*[F.col(g).alias(c) for c, g in zip(carry, given, strict=True)], *[F.col(c).alias(f"{prefix}{c}") for c in (*numbers, "n_best", "count_sum", shown)])


def _pieces(model: bytes) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model).get_piece_size()
