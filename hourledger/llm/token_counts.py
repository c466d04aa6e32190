"""Token counts by a compiled finite-state tokenizer.

Greedy pair merging has a finite memory. A sequence of pieces is the tokenizer's result if and only
if each adjacent pair of pieces is what merging makes of the two pieces' text alone. So a text can be
read from left to right: for each position the last piece of the text so far is the one piece that
ends there and agrees with the last piece of the text before it. The state after a character holds
the positions from which a longer piece may still grow, the last piece before each, and how many
pieces that prefix has less than the whole. Each transition is annotated with the change of the
count, so a text's count is the sum of the annotations on its path.

States and transitions are compiled when first needed and kept in dense tables, which numpy walks
for many chunks in step. No piece holds a space after another character, so a space that follows
another character leads to the same state from everywhere: the map of a chunk that begins there is
constant. Chunks in long texts without spaces have real maps; they are evaluated on the states that
a prefix scan over the chunks brings in, until nothing changes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourledger.llm.arrow import kept, map_texts, text_bytes

SPACE = "▁"
#: Characters in a chunk, about.
CHUNK = 256
#: Cells of the transition table; when full it is emptied and compiled anew.
MAX_CELLS = 1 << 25
#: States that the table grows by.
MORE_STATES = 1 << 14
#: Fixed classes: a space that follows another character, then characters in no longer piece by cost.
SYNC, ALONE = 0, 1


class Transducer:
    """The compiled tokenizer; `pieces` maps a piece to its score, the higher the earlier merged."""

    def __init__(self, pieces: dict[str, float], max_cells: int = MAX_CELLS):
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece holds a space after another character")
        self.pieces = pieces
        self.max_cells = max_cells
        self.nodes: dict[tuple[int, str], int] = {}
        self.piece_of: list[str | None] = [None]
        self.inner: list[bool] = [False]
        for piece in pieces:
            if len(piece) > 1:
                at = 0
                for char in piece:
                    self.inner[at] = True
                    at = self._child(at, char)
                self.piece_of[at] = piece
        for (at, char), node in list(self.nodes.items()):
            if at == 0:
                self.piece_of[node] = char
        self.chars = {char for piece in pieces if len(piece) > 1 for char in piece}
        for char in sorted(self.chars):
            self.piece_of[self._child(0, char)] = char
        # Class of each code point; 0 stands for "not seen yet" except for the fixed classes.
        self.class_of = np.zeros(0x110000, np.int32)
        self.char_of: list[str] = [SPACE, "", "", "", ""]  # the fixed classes come first
        self._empty(128)

    def _child(self, at: int, char: str) -> int:
        node = self.nodes.get((at, char))
        if node is None:
            node = self.nodes[at, char] = len(self.piece_of)
            self.piece_of.append(None)
            self.inner.append(False)
        return node

    def _cost(self, piece: str) -> int:
        return 1 if piece in self.pieces else len(piece.encode())

    def _empty(self, columns: int) -> None:
        self.columns = columns
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.agree: dict[tuple[str, str], bool] = {}
        self.entries: dict[tuple, tuple] = {}
        self.rows = MORE_STATES
        self.next = np.full(self.rows * columns, -1, np.int32)
        self.change = np.zeros(self.rows * columns, np.int8)
        self._state(((0, None, 0),))

    def _state(self, entries: tuple) -> int:
        state = self.number.get(entries)
        if state is None:
            entries = tuple(self.entries.setdefault(entry, entry) for entry in entries)
            state = self.number[entries] = len(self.states)
            self.states.append(entries)
            if state >= self.rows:
                more = MORE_STATES * self.columns
                self.next = np.concatenate([self.next, np.full(more, -1, np.int32)])
                self.change = np.concatenate([self.change, np.zeros(more, np.int8)])
                self.rows += MORE_STATES
        return state

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self.class_of[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]).tolist():
                char = SPACE if code == 32 else chr(code)
                if char not in self.chars:
                    self.class_of[code] = ALONE + self._cost(char) - 1
                elif code == 32 or char == SPACE:
                    if SPACE not in self.char_of[1:]:
                        self.char_of.append(SPACE)
                    self.class_of[code] = self.char_of.index(SPACE, 1)
                else:
                    self.class_of[code] = len(self.char_of)
                    self.char_of.append(char)
            if len(self.char_of) > self.columns:
                self._empty(2 * len(self.char_of))
            found = self.class_of[codes]
        return found

    def _agrees(self, left: str | None, right: str) -> bool:
        """Merging the two pieces' text gives these two pieces."""
        if left is None:
            return True
        known = self.agree.get((left, right))
        if known is None:
            symbols = list(left + right)
            while True:
                best, at = None, -1
                for i in range(len(symbols) - 1):
                    score = self.pieces.get(symbols[i] + symbols[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            known = self.agree[left, right] = symbols == [left, right]
        return known

    def _compile(self, state: int, klass: int) -> None:
        if ALONE <= klass < ALONE + 4:
            target, change = 0, klass - ALONE + 1
        else:
            entries = self.states[0 if klass == SYNC else state]
            char, grown, last = self.char_of[klass], [], None
            for node, before, behind in entries:
                child = self.nodes.get((node, char))
                if child is None:
                    continue
                piece = self.piece_of[child]
                if piece is not None and last is None and self._agrees(before, piece):
                    last = (piece, self._cost(piece) - behind)
                if self.inner[child]:
                    grown.append((child, before, behind))
            piece, change = last
            target = self._state((*((n, b, behind + change) for n, b, behind in grown), (0, piece, 0)))
        cell = state * self.columns + klass
        self.next[cell], self.change[cell] = target, change

    def walk(self, classes: np.ndarray, begins: np.ndarray, lengths: np.ndarray, states: np.ndarray):
        """End state and count of each chunk from its start state, all chunks in step."""
        order = np.argsort(-lengths, kind="stable")
        at, left, state = begins[order], lengths[order], states[order].astype(np.int64)
        counts = np.zeros(len(order), np.int64)
        active = len(order) - np.searchsorted(left[::-1], np.arange(int(left[0]) if len(left) else 0), "right")
        for step, n in enumerate(active.tolist()):
            cell = state[:n] * self.columns + classes[at[:n] + step]
            target = self.next[cell]
            if target.min() < 0:
                for missing in np.unique(cell[target < 0]).tolist():
                    self._compile(*divmod(missing, self.columns))
                target = self.next[cell]
            state[:n] = target
            counts[:n] += self.change[cell]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], counts[back]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a block of UTF-8 bytes."""
        texts = len(offsets) - 1
        if len(self.states) * self.columns > self.max_cells:
            self._empty(self.columns)
        # Each text but an empty one gets a space in front.
        filled = np.flatnonzero(np.diff(offsets))
        if not len(filled):
            return np.zeros(texts, np.int64)
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        codes = np.insert(codes, before[filled], 32)
        begins = before[filled] + np.arange(len(filled))
        ends = np.append(begins[1:], len(codes))
        classes = self.classes(codes)
        space = self.class_of[32]
        is_space = classes == space
        sync = is_space & ~np.concatenate([[False], is_space[:-1]])
        sync[begins] = True
        classes = np.where(sync, SYNC, classes)
        starts, fresh = self._cuts(np.flatnonzero(sync), begins, ends)
        lengths = np.diff(np.append(starts, len(codes)))
        # Prefix scan: what comes into a chunk is what the one before gives.
        incoming = np.zeros(len(starts), np.int64)
        states, counts = self.walk(classes, starts, lengths, incoming)
        while True:
            wanted = np.where(fresh, 0, np.concatenate([[0], states[:-1]]))
            again = np.flatnonzero(wanted != incoming)
            if not len(again):
                break
            incoming[again] = wanted[again]
            states[again], counts[again] = self.walk(classes, starts[again], lengths[again], incoming[again])
        result = np.zeros(texts, np.int64)
        result[filled] = np.add.reduceat(counts, np.searchsorted(starts, begins))
        return result

    @staticmethod
    def _cuts(sync: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks begin, and whether their start state is the fixed one."""
        near = sync[np.unique(np.searchsorted(sync, np.arange(0, int(ends[-1]), CHUNK)).clip(max=len(sync) - 1))]
        fixed = np.union1d(near, begins)
        gaps = np.diff(np.append(fixed, ends[-1]))
        parts = np.maximum(gaps // (4 * CHUNK), 1)
        starts = np.repeat(fixed, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * 4 * CHUNK
        return starts, np.isin(starts, fixed)


def load_pieces(path: str) -> dict[str, float]:
    """Normal pieces of a sentencepiece pair-merging model with byte fallback, and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = ""
) -> DataFrame:
    """The carried columns (the id), n_bytes, n_tokens and over_limit of every row's whole text.

    A null or empty text has no bytes and no tokens. Every row gives a row, also with a null or
    repeated id; an empty table gives none. Other columns are not read, so their names cannot
    clash. The driver reads the vocabulary, whose size is fixed, and broadcasts it.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def start():
        transducer = kept(("transducer", path), lambda: Transducer(pieces.value))

        def work(texts: pa.Array) -> list:
            data, offsets = text_bytes(texts)
            counts = transducer.count(data, offsets)
            return [np.diff(offsets), counts, counts > limit]

        return work

    outputs = {f"{prefix}n_bytes": "long", f"{prefix}n_tokens": "long", f"{prefix}over_limit": "boolean"}
    return map_texts(docs, text_col, carry or [id_col], outputs, start)
