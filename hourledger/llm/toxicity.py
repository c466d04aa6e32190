"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are words and the beginnings of words, which inflected forms share. The terms that tell the
labels apart best make up the vocabulary; their document frequencies are counted over all documents.
Labelled examples are indexed by term in blocks, each with the largest weight of its postings. A
query visits blocks of examples in the order of their upper bound, the query's weights times the
blocks' largest, and stops when the bound falls below the k-th best cosine, which is exact. Examples
with equal vectors stand in the index once, with their number; those tied at the k-th place share the
votes that are left. Votes are weighted by cosine, over a prior of the labelled texts that hold no term of the vocabulary.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.arrow import blocks, kept, map_texts, ragged
from hourledger.session import shared_dir

#: Labelled rows that the classifier is fitted on, chosen by a hash of their id.
MAX_EXAMPLES = 20_000
#: Terms in the vocabulary, the labelled rows a term must be in, and the least chi-square of a term.
MAX_TERMS, LEAST_ROWS, LEAST_CHI2 = 4096, 4, 20.0
#: Lengths of the beginnings of words that are terms too.
BEGINNINGS = (4, 5, 6)
#: Nearest examples that vote, and examples in a block of the index.
K, BLOCK = 15, 32
#: Blocks that a query visits at first; each further visit takes four times as many of those left.
FIRST_BLOCKS = 8
#: Weight of the prior beside the votes.
PRIOR_WEIGHT = 0.25
#: Results that a worker remembers at most; beyond that it works them out anew.
REMEMBERED = 200_000
#: Terms that a task counts before it passes its counts on.
COUNTED = 100_000
ASCII_SPLIT = bytes(32 if chr(i) in "\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~!'0123456789" else i for i in range(256))


def words_of(text: str) -> list[str]:
    # Bytes of ASCII stand for themselves in UTF-8, and translating bytes is many times faster.
    return text.lower().encode().translate(ASCII_SPLIT).decode().split()


def all_terms(text: str) -> set[str]:
    return {t for word in set(words_of(text)) for t in (word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n))}


class Vocabulary:
    """Numbers of the chosen terms; finds those of a text and how often each occurs."""

    def __init__(self, chosen: list[str]):
        self.number = {t: i for i, t in enumerate(chosen)}
        # Every term of a word begins as the word does, so most words are told by their first letters alone.
        self.least = min(BEGINNINGS)
        self.roots = {t.removesuffix("*")[: self.least] for t in chosen}

    def find(self, text: str) -> dict[int, int]:
        found: dict[int, int] = {}
        roots, least = self.roots, self.least
        for word, count in Counter([w for w in words_of(text) if w[:least] in roots]).items():
            for term in (word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)):
                if (i := self.number.get(term)) is not None:
                    found[i] = found.get(i, 0) + count
        return found


def unit_vector(found: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(sorted(found), np.int64)
    weight = (1 + np.log(np.array([found[i] for i in at.tolist()], np.float64))) * idf[at]
    return at, weight / np.sqrt((weight**2).sum())


class Index:
    """Labelled examples in inverted lists, cut into blocks of vectors with bounds of their own.

    Examples with equal term counts are one vector with a number of examples and of toxic ones.
    """

    def __init__(self, chosen: list[str], idf: np.ndarray, examples: list[tuple[str, int, dict[int, int]]], prior: float):
        self.vocabulary, self.idf, self.prior = Vocabulary(chosen), idf, prior
        self.remembered: dict[tuple, tuple[float, list[str]]] = {}
        alike: dict[tuple, list[tuple[str, int]]] = {}
        for name, toxic, found in examples:
            alike.setdefault(self.key(found), []).append((name, toxic))
        vectors = [(min(rows), rows, *unit_vector(dict(key), idf)) for key, rows in alike.items()]
        # Vectors with the same strongest term stand together, so that a block's bounds are tight.
        vectors.sort(key=lambda v: (int(v[2][v[3].argmax()]), v[0]))
        # No more than K of a vector's names are ever evidence.
        self.names = [[name for name, _ in sorted(v[1])[:K]] for v in vectors]
        self.size = np.array([len(v[1]) for v in vectors], np.int64)
        self.toxic = np.array([sum(toxic for _, toxic in v[1]) / len(v[1]) for v in vectors], np.float64)
        # Postings by term, then by block; `posted` tells where those of a term in a block begin.
        lengths = np.array([len(v[2]) for v in vectors], np.int64)
        term = np.concatenate([np.zeros(0, np.int64), *(v[2] for v in vectors)])
        place = np.repeat(np.arange(len(vectors)), lengths)
        weight = np.concatenate([np.zeros(0), *(v[3] for v in vectors)])
        order = np.lexsort((place, term))
        self.place, self.weight = place[order], weight[order]
        count = -(-len(vectors) // BLOCK)
        cell = term[order] * count + self.place // BLOCK
        self.posted = np.searchsorted(cell, np.arange(len(chosen))[:, None] * count + np.arange(count + 1))
        self.block_max = np.zeros((len(chosen), count), np.float32)
        # Rounded up, so that single precision never makes a bound too low.
        np.maximum.at(self.block_max.reshape(-1), cell, np.nextafter(self.weight.astype(np.float32), np.float32(2)))

    @staticmethod
    def key(found: dict[int, int]) -> tuple:
        """Equal for equal unit vectors of counts; how often its only term occurs does not turn a vector."""
        return tuple(sorted(found.items())) if len(found) > 1 else ((next(iter(found)), 1),)

    def nearest(self, found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the vectors nearest first, up to the one that holds the K-th example and its ties."""
        at, weight = unit_vector(found, self.idf)
        bounds = weight @ self.block_max[at]
        order = np.argsort(-bounds, kind="stable")[: int((bounds > 0).sum())]
        places, cosines, last, visited = np.zeros(0, np.int64), np.zeros(0), 0.0, FIRST_BLOCKS
        while len(order):
            some, order = order[:visited], order[visited:]
            visited *= 4
            here, cosine = self.cosines(at, weight, some)
            hit = np.flatnonzero((cosine > 0) & (cosine >= last))
            places, cosines = np.concatenate([places, here[hit]]), np.concatenate([cosines, cosine[hit]])
            best = np.lexsort((places, -cosines))
            places, cosines = places[best], cosines[best]
            held = np.cumsum(self.size[places])
            if len(held) and held[-1] >= K:
                last = cosines[np.searchsorted(held, K)]
                near = cosines >= last
                places, cosines = places[near], cosines[near]
            order = order[bounds[order] * (1 + 1e-9) >= last]
        return places, cosines

    def cosines(self, at: np.ndarray, weight: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vectors of some blocks, and their cosines with a query's vector."""
        first = self.posted[at[:, None], some].ravel()
        lengths = self.posted[at[:, None], some + 1].ravel() - first
        posting = ragged(first, lengths)
        slot = np.repeat(np.tile(np.arange(len(some)), len(at)), lengths) * BLOCK + self.place[posting] % BLOCK
        product = np.repeat(np.repeat(weight, len(some)), lengths) * self.weight[posting]
        here = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        return here, np.bincount(slot, product, len(here))

    def votes(self, cosines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many of the K votes each vector has; vectors tied at the K-th share what is left by their sizes."""
        tied = cosines == cosines[-1]
        left = K - sizes[~tied].sum()
        return np.where(tied, sizes * min(1.0, left / sizes[tied].sum()), sizes)

    def score(self, found: dict[int, int]) -> tuple[float, list[str]]:
        if not found or not len(self.size):
            return self.prior, []
        key = self.key(found)
        if (known := self.remembered.get(key)) is not None:
            return known
        at, cosine = self.nearest(dict(key))
        result = (self.prior, [])
        if len(at):
            weight = cosine * self.votes(cosine, self.size[at])
            votes = (weight * self.toxic[at]).sum() + PRIOR_WEIGHT * self.prior
            score = min(1.0, max(0.0, float(votes / (weight.sum() + PRIOR_WEIGHT))))
            result = score, [name for i in at.tolist() for name in self.names[i]][:K]
        if len(self.remembered) < REMEMBERED:
            self.remembered[key] = result
        return result


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """What an `Index` is made of, fitted on at most MAX_EXAMPLES labelled documents; document frequencies come from all of `docs`.

    `labels` holds the ids to learn from. Null ids and labels are left out; an id with several labels
    is toxic if any says so. Without examples every score is 0.5.
    """
    key, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    chosen = labels.where(key.isNotNull() & label.isNotNull()).groupBy(key.alias("id")).agg(F.max(label).cast("int").alias("toxic"))
    # The lowest hashes, cut by their expected share first, so that no task sorts more than the bound and a little.
    share = min(1.0, 1.1 * MAX_EXAMPLES / max(chosen.count(), 1))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    chosen = chosen.where(place < int(share * (1 << 30))).orderBy(place, "id").limit(MAX_EXAMPLES)
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"))
    # The chosen ids are MAX_EXAMPLES at most, which bounds the broadcast.
    sample = texts.join(F.broadcast(chosen), "id").select(F.col("id").cast("string"), "toxic", F.coalesce("text", F.lit("")).alias("text"))

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: Counter(), 1: Counter()}

        def passed_on() -> pa.RecordBatch:
            keys = list(sums[0].keys() | sums[1].keys())
            made = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([sums[k][t] for t in keys], pa.int64()) for k in (1, 0))], ["term", "toxic", "clean"])
            sums[0].clear()
            sums[1].clear()
            return made

        for batch in blocks(batches, 1):
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                sums[toxic].update(all_terms(text.as_py()))
                sums[toxic][""] += 1
                if len(sums[0]) + len(sums[1]) > COUNTED:
                    yield passed_on()
        yield passed_on()

    # Copies of a text count once.
    distinct = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text")
    counts = distinct.mapInArrow(count_terms, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    shared_dir(docs.sparkSession)
    counts = counts.checkpoint()
    total = counts.where("term = ''").first()
    toxic, clean = (total.toxic, total.clean) if total else (0, 0)
    if not toxic + clean:
        return {"chosen": [], "idf": np.zeros(0), "examples": [], "prior": 0.5}
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate = toxic / (toxic + clean)
    expected = (a + b) * rate
    chi2 = (a - expected) ** 2 / (expected * (1 - rate)) if 0 < rate < 1 else F.lit(0.0)
    telling = counts.where((F.col("term") != "") & (a + b >= LEAST_ROWS) & (a > expected)).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
    vocabulary = [r.term for r in telling.orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).select("term").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, sums = Vocabulary(shared.value).find, Counter()
        for batch in blocks(batches, 0):
            for text in batch.column(0).to_pylist():
                sums.update(find(text or "").keys())
                sums[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())], ["term", "n"])

    frequency = {r.term: r.n for r in texts.select("text").mapInArrow(count_documents, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.array([frequency.get(i, 0) for i in range(len(vocabulary))], np.float64)
    idf = np.log((frequency.get(-1, 0) + 1) / (df + 1)) + 1

    def find_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Vocabulary(shared.value).find
        for batch in blocks(batches, 2):
            found = [find(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(f.items()) for f in found], pa.map_(pa.int32(), pa.int64()))], ["id", "toxic", "found"])

    examples = [(r.id, r.toxic, r.found) for r in sample.mapInArrow(find_terms, "id string, toxic int, found map<int,long>").collect()]
    without = [t for _, t, found in examples if not found]
    prior = (sum(without) + 0.5) / (len(without) + 2)
    return {"chosen": vocabulary, "idf": idf, "examples": [e for e in examples if e[2]], "prior": prior}


def score_toxicity(
    docs: DataFrame, fitted: dict, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = ""
) -> DataFrame:
    """The carried columns (the id), score (0 to 1), predicted (1 from 0.5 on) and evidence.

    Evidence lists the ids of the examples that voted, nearest first. A null or empty text, or one
    without a term of the vocabulary, gets the prior and no evidence. Every row gives a row, repeated
    ones too. Nothing but the text is an input of the score.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(fitted), uuid.uuid4().hex

    def start():
        known = kept(("toxicity", name), lambda: Index(**shared.value))

        def work(texts: pa.Array) -> list:
            results = [known.score(known.vocabulary.find(text or "")) for text in texts.to_pylist()]
            scores = np.array([score for score, _ in results])
            return [scores, (scores >= 0.5).astype(np.int32), pa.array([names for _, names in results], pa.list_(pa.string()))]

        return work

    kinds = {"score": T.DoubleType(), "predicted": T.IntegerType(), "evidence": T.ArrayType(T.StringType())}
    return map_texts(docs, text_col, carry or [id_col], {f"{prefix}{k}": v for k, v in kinds.items()}, start)
