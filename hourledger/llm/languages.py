"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and the n-grams of one to three
characters that hold a letter are hashed into a fixed number of features. Counts per language come
from all training texts; each task sums its own first. The matrix of log-probabilities (features by
languages) is broadcast, and a batch of texts is scored as a sparse matrix in rows: the features of
all texts in a row, summed from text to text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourledger.llm.arrow import blocks, kept, map_texts, text_bytes

FEATURE_BITS = 16
GRAMS = (1, 2, 3)
#: The model is a dense matrix on the driver and in each worker; more languages than this are an error.
MAX_LANGUAGES = 500
#: Added to each count of a feature in a language.
SMOOTHING = 0.1
#: Bytes of text that are scored at a time; the arrays made of them take some seventy times as many.
BLOCK = 1 << 18
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # languages x features, float32
    log_prior: np.ndarray


def letter_table() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each letter, marks as they are, 32 for everything else; and which are letters."""
    table, letters = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] in "LM":
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
            letters[code] = unicodedata.category(char)[0] == "L"
    return table, letters


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts as the features see them, where each text begins, and how many letters stand before that."""
    data, offsets = text_bytes(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    table, letters = kept(("letters",), letter_table)
    return table[codes], begins, np.concatenate([[0], np.cumsum(letters[codes])])[begins]


def features(codes: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the features in order of place, and how many of them begin before each text."""
    owner_end = np.repeat(begins[1:], np.diff(begins))
    places = np.arange(len(codes))
    letter = codes != 32
    for n in GRAMS:
        last = len(codes) - n + 1
        if last <= 0:
            continue
        mixed = np.full(last, n, np.uint32)
        some = np.zeros(last, bool)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + last]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            some |= letter[k : k + last]
        some &= places[:last] + n <= owner_end[:last]
        before = np.concatenate([[0], np.cumsum(some)])
        yield (mixed[some] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - FEATURE_BITS), before[np.minimum(begins, last)]


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from all rows with a non-null language; null and empty texts count as rows only.

    Without any such row the model knows no language and every prediction is `und`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        size = 1 << FEATURE_BITS
        for batch in blocks(batches, 0, BLOCK):
            langs = batch.column(1).dictionary_encode()
            own, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            found = np.zeros((len(names), size + 1), np.int64)
            found[:, size] = np.bincount(own, minlength=len(names))
            for hashed, before in features(*normalised(batch.column(0))[:2]):
                of = np.repeat(own, np.diff(before)).astype(np.int64)
                found[:, :size] += np.bincount(of * size + hashed, minlength=len(names) * size).reshape(-1, size)
            for name, row in zip(names, found, strict=True):
                sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])], ["lang", "feature", "n"])

    rows = docs.select(F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")).where(F.col(f"`{lang_col}`").isNotNull())
    counts = rows.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    # At most languages x features rows come to the driver; the number of languages is checked first.
    languages = [r.lang for r in rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang")).distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    size = 1 << FEATURE_BITS
    table = np.zeros((len(languages), size + 1))
    if languages:
        found = counts.toArrow()
        number = {name: k for k, name in enumerate(languages)}
        encoded = found.column("lang").combine_chunks().dictionary_encode()
        places = np.array([number[name] for name in encoded.dictionary.to_pylist()])
        table[places[encoded.indices.to_numpy()], found.column("feature").to_numpy()] = found.column("n").to_numpy()
    smooth = table[:, :size] + SMOOTHING
    log_prob = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    rows_of = table[:, size] + 1.0
    return LanguageModel(languages, log_prob.astype(np.float32), np.log(rows_of / rows_of.sum()))


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = ""
) -> DataFrame:
    """The carried columns (the id), lang_pred and score (the posterior of lang_pred, 0 to 1).

    A text that is null, empty or without letters is `und` with score 0, and so is every text under a
    model without languages. Ties go to the first language in order. Every row gives a row, repeated
    ones too. Nothing but the text is an input of the prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))

    def start():
        known = LanguageModel(*shared.value)

        def work(texts: pa.Array) -> list:
            codes, begins, letters = normalised(texts)
            scores = np.tile(known.log_prior, (len(texts), 1))
            readable = (np.diff(letters) > 0) & (len(known.languages) > 0)
            for hashed, before in features(codes, begins):
                filled = np.flatnonzero(np.diff(before))
                for k in range(len(known.languages)):
                    if len(filled):
                        scores[filled, k] += np.add.reduceat(known.log_prob[k][hashed], before[filled], dtype=np.float64)
            if not len(known.languages):
                return [pa.array([UNKNOWN] * len(texts), pa.string()), np.zeros(len(texts))]
            best = scores.argmax(axis=1)
            top = scores[np.arange(len(texts)), best]
            posterior = 1 / np.exp(scores - top[:, None]).sum(axis=1)
            names = [known.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), readable.tolist(), strict=True)]
            return [pa.array(names, pa.string()), np.where(readable, posterior, 0.0)]

        return work

    return map_texts(docs, text_col, carry or [id_col], {f"{prefix}lang_pred": "string", f"{prefix}score": "double"}, start, BLOCK)
