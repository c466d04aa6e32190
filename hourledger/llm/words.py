"""Words between white space, hashed in bulk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from hourledger.llm.arrow import text_bytes

#: An odd factor; a word's hash is a polynomial of its bytes in it, modulo 2**64, well mixed.
FACTOR = 0x9E3779B97F4A7C15
#: Bytes that are hashed at a time; longer texts are cut at white space where there is any.
PIECE = 1 << 18
WHITE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: What a byte adds to a hash, before its power.
CODES = np.where(WHITE, 0, LOWER.astype(np.uint64) + np.uint64(1)).astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, A-Z lower-cased, and how many begin before each text."""
    hashes, _, begins = words_and_endings(texts)
    return hashes, begins


def words_and_endings(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `hashed_words`, with the last three bytes of each word as a number in between.

    Two different words share a hash with a chance of 2**-64.
    """
    data, offsets = text_bytes(texts)
    hashes, endings, starts = [], [], []
    at, powers = 0, _powers(min(len(data), PIECE))
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            white = np.flatnonzero(WHITE[data[at:end]])
            inner = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(at + int(white[-1]) + 1 if len(white) else at, int(inner))
            end = cut if cut > at else len(data)
        found, last, where = _piece(data[at:end], offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at, powers)
        hashes.append(found)
        endings.append(last)
        starts.append(where + at)
        at = end
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    endings = np.concatenate(endings) if endings else np.zeros(0, np.int64)
    return hashes, endings, np.searchsorted(starts, offsets)


def _piece(data: np.ndarray, text_starts: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    solid = ~WHITE[data]
    if not solid.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[text_starts] |= solid[text_starts]
    ends[:-1] &= ~solid[1:]
    before = text_starts[text_starts > 0] - 1
    ends[before] |= solid[before]
    starts, last = np.flatnonzero(begins), np.flatnonzero(ends)
    # White space counts 0, and the power of a word's place is divided out: no byte's place in its word is needed.
    power, inverse = powers if len(data) <= len(powers[0]) else _powers(len(data))
    values = CODES[data]
    values *= power[: len(data)]
    endings = np.zeros(len(starts), np.int64)
    for back in range(3):
        at = last - back
        endings = endings * 256 + np.where(at >= starts, LOWER[data[at.clip(min=0)]], 0)
    return mix(np.add.reduceat(values, starts) * inverse[starts]), endings, starts


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor's powers from 0 to n - 1, and their inverses modulo 2**64."""
    power, inverse = np.ones((2, n), np.uint64)
    power[1:], inverse[1:] = FACTOR, pow(FACTOR, -1, 1 << 64)
    return np.multiply.accumulate(power), np.multiply.accumulate(inverse)
