"""Byte-pair encoding and decoding with a pair occurrence index.

A task collects the distinct words of a block that it has not met yet (white space always ends a
word, so what stands between white space is looked up as one), lays their symbols out in one array
and maps each mergeable pair to all its positions. Active ranks are taken in ascending order: a
merge is applied at all positions of its pair at once, and the pairs it creates at its neighbours
join the lists of their own ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourledger.llm.arrow import kept, map_texts

#: Bytes of the chunks between white space that a worker remembers, with their ids and texts; beyond, it forgets all.
KNOWN_BYTES = 48 << 20
#: What the objects of a remembered chunk take beside their content.
ENTRY_BYTES = 300
#: Bytes of text whose new chunks are merged at once; a merge takes many times its bytes.
MERGED_BYTES = 2 << 20
#: What the tokenizer file splits on, and white space as its library understands it.
SHORT_FORMS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE = r"\t-\r \x85\xa0  -     　"


def category_ranges(letter: str) -> str:
    """All characters of a general category as ranges of a character class."""
    codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == letter]
    ends = [k for k in range(len(codes)) if k + 1 == len(codes) or codes[k + 1] > codes[k] + 1]
    starts = [0, *(k + 1 for k in ends[:-1])]
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[b]:08x}" for a, b in zip(starts, ends, strict=True))


def word_pattern() -> str:
    """Short forms, runs of letters, single numbers and runs of anything else that is not white."""
    letters, numbers = category_ranges("L"), category_ranges("N")
    return rf"{SHORT_FORMS}|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Encoder:
    """The merges of one tokenizer file: byte level, lower case, with a suffix at word ends."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = max(self.vocab.values()) + 1
        self.left, self.right, self.made = (
            np.array([self.vocab[x] for x in part], np.int64)
            for part in (*zip(*merges, strict=True), [a + b for a, b in merges])
        )
        born = np.full(self.size, -1)
        born[self.made[::-1]] = np.arange(len(merges))[::-1]
        if (np.maximum(born[self.left], born[self.right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge uses a piece that only a later merge makes")
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        symbols = byte_symbols()
        self.inside = np.array([self.vocab[s] for s in symbols], np.int64)
        self.at_end = np.array([self.vocab[s + self.suffix] for s in symbols], np.int64)
        self.text_of = {i: piece for piece, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for piece, i in self.special.items():
            self.text_of[i] = piece
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.find_chunks = re.compile(f"[^{WHITE}]+").findall
        self.find_words = re.compile(spec["words"]).findall
        self.known: dict[str, tuple[bytes, str]] = {}
        self.held = 0

    def chunks(self, text: str) -> list[str]:
        """What stands between white space; special tokens stand alone, with a mark before."""
        if any(s in text for s in self.special):
            parts = self.split_special(text)
            return [c for k, part in enumerate(parts) for c in (["\0" + part] if k % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # Lower case is taken for each character by itself, so a sigma never becomes a final one.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white to str.split only
            return self.find_chunks(text)
        return text.split()

    def learn(self, chunks: list[str]) -> None:
        """Put the ids and the decoded text of the chunks into `known`."""
        for c in [c for c in chunks if c[0] == "\0" and c[1:] in self.special]:
            self.known[c] = np.array([self.special[c[1:]]], "<u4").tobytes(), c[1:]
        plain = [c for c in chunks if c not in self.known]
        words = [self.find_words(c) for c in plain]
        distinct = list(set().union(*words))
        if not distinct:
            return
        symbols, starts = self.merge([w.encode() for w in distinct])
        ids, texts = symbols.astype("<u4").tobytes(), [self.text_of[i] for i in symbols.tolist()]
        begins = starts.tolist()
        own = {w: (ids[4 * a : 4 * b], " ".join(texts[a:b])) for w, a, b in zip(distinct, begins, [*begins[1:], len(texts)], strict=True)}
        for c, parts in zip(plain, words, strict=True):
            if len(parts) == 1:
                self.known[c] = own[parts[0]]
            else:
                self.known[c] = b"".join([own[w][0] for w in parts]), " ".join([own[w][1] for w in parts])
            self.held += ENTRY_BYTES + 2 * len(c) + len(self.known[c][0])

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word begins."""
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        symbol = np.append(self.inside[data], -1)
        symbol[ends - 1] = self.at_end[data[ends - 1]]
        # Neighbours; n stands for none, and merged-away positions have symbol -2.
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - lengths] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            key = symbol[at] * self.size + symbol[after[at]]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            fits = self.keys[place] == key
            rank, at = self.rank_of[place[fits]], at[fits]
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            firsts = rank[np.concatenate([[0], cuts])].tolist() if len(rank) else []
            for r, positions in zip(firsts, np.split(at, cuts), strict=False):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(positions)

        note(np.flatnonzero(after[:n] < n))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            at = at[(symbol[at] == self.left[r]) & (symbol[after[at]] == self.right[r])]
            if self.left[r] == self.right[r] and len(at) > 1:
                # In a run of equal symbols every second pair overlaps the one before it.
                begins = np.concatenate([[True], after[at[:-1]] != at[1:]])
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at], symbol[gone] = self.made[r], -2
            after[at] = after[gone]
            before[after[at]] = at
            near = before[at]
            note(np.concatenate([near[near < n], at[after[at] < n]]))
        alive = symbol[:n] >= 0
        counts = np.add.reduceat(alive, ends - lengths)
        return symbol[:n][alive], np.cumsum(counts) - counts

    def run(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian bytes and decoded text of each text.

        A text is split twice, once for what is new in it: the chunks of all texts, as objects, would
        take many times the room of the texts.
        """
        if self.held > KNOWN_BYTES:
            self.known.clear()
            self.held = 0
        new: set[str] = set()
        for text in texts:
            new.update(self.chunks(text))
        new.difference_update(self.known)
        self.learn(list(new))
        del new
        known = self.known
        for text in texts:
            found = [known[c] for c in self.chunks(text)]
            yield b"".join([ids for ids, _ in found]), " ".join([text for _, text in found if text])


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] or spec["post_processor"]:
        raise ValueError("not a byte-level pair-merging tokenizer with word ends")
    return {"words": word_pattern()} | {"model": {k: model[k] for k in ("vocab", "merges", "end_of_word_suffix")}, "added_tokens": spec["added_tokens"]}


def encode_decode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = "", digest: bool = False
) -> DataFrame:
    """The carried columns (the id), n_tokens, ids (little-endian unsigned 32-bit) and decoded text.

    With `digest` the SHA-256 digests ids_sha256 and decoded_sha256 stand in place of the last two.
    A null or empty text has no tokens and decodes to the empty text. Special tokens in a text are
    read as such. Every row gives a row, also with a null or repeated id; an empty table gives none.
    Other columns are not read. The driver reads the vocabulary, of fixed size, and broadcasts it.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(path))

    def start():
        encoder = kept(("bpe", path), lambda: Encoder(spec.value))
        kinds = [pa.int64(), *([pa.string(), pa.string()] if digest else [pa.binary(), pa.string()])]

        def work(texts: pa.Array) -> list:
            results = encoder.run([t or "" for t in texts.to_pylist()])
            if digest:  # as they come, so that no block's ids and texts lie in memory at once
                results = ((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()) for ids, text in results)
            else:
                results = ((len(ids) // 4, ids, text) for ids, text in results)
            rows = list(results)
            return [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]

        return work

    columns = {"ids_sha256": "string", "decoded_sha256": "string"} if digest else {"ids": "binary", "decoded": "string"}
    outputs = {f"{prefix}{k}": v for k, v in ({"n_tokens": "long"} | columns).items()}
    return map_texts(docs, text_col, carry or [id_col], outputs, start, MERGED_BYTES)
