"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation.

Words are told by 64-bit hashes. Each word belongs to a unit: a frequent word is its own, the others
share units by their last bytes, and the end of a text is one. The probability of a word is its
unit's, given the two tokens before, times its smoothed share of its unit. The model adds the
context units' vectors, each weighted by its place, and scores all units against the sum by a
matrix product, so a softmax gives normalised probabilities. Contexts that repeat within a batch are
computed once.

Word counts come from all training texts. Training runs in the tasks that read them: each makes
steps of noise-contrastive estimation in numpy over its own tokens, and the tasks' parameters are
averaged by the number of their tokens. Counts of frequent words, a bounded number, are broadcast;
the other words of a text leave the task as rows and meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.arrow import blocks
from hourledger.llm.words import mix, words_and_endings
from hourledger.operators.reduced import join_reduced
from hourledger.session import shared_dir

#: Frequent words that are their own units, units that other words share, and the end's unit.
HEAD, TAIL = 767, 256
UNITS, END = HEAD + TAIL + 1, HEAD + TAIL
#: At most so many words' counts are broadcast; all others are joined.
FREQUENT = 200_000
#: Length of a vector, noise units and positions of a step, step size.
WIDTH, NOISE, STEP, RATE = 24, 64, 4096, 0.15
#: Contexts whose distributions are computed at a time.
CONTEXTS = 8192
#: Added to each count, as in the base score.
ADDED = 0.1
#: The end's key; no word's, but by a chance of 2**-64.
END_KEY = np.uint64(0)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and endings of all tokens, every text's followed by its end, and where each text begins."""
    hashes, endings, begins = words_and_endings(texts)
    texts_before = np.arange(len(begins))
    ends = begins[1:] + texts_before[:-1]
    keys, last = np.full(len(hashes) + len(begins) - 1, END_KEY), np.zeros(len(hashes) + len(begins) - 1, np.int64)
    is_word = np.ones(len(keys), bool)
    is_word[ends] = False
    keys[is_word], last[is_word] = hashes, endings
    return keys, last, begins + texts_before


def tail_unit(endings: np.ndarray) -> np.ndarray:
    return HEAD + (mix(endings.astype(np.uint64)) % np.uint64(TAIL)).astype(np.int64)


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.searchsorted(table, keys).clip(max=len(table) - 1)
    return place, table[place] == keys


def units(keys: np.ndarray, endings: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Unit of each token; `head` holds the frequent words' keys in ascending order."""
    place, there = lookup(head, keys)
    # Sixteen bits, which numpy sorts by their digits.
    return np.where(keys == END_KEY, END, np.where(there, place, tail_unit(endings))).astype(np.int16)


def contexts(unit: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units before each token and before that; the end's unit stands before a text."""
    one, two = np.full(len(unit), END, np.int16), np.full(len(unit), END, np.int16)
    one[1:], two[2:] = unit[:-1], unit[:-2]
    starts = begins[:-1][begins[:-1] < len(unit)]
    one[starts] = two[starts] = END
    second = starts[starts + 1 < len(unit)] + 1
    two[second] = END
    return one, two


class Model:
    """Vectors of context and target units, weights of the two places, and biases."""

    SHAPES = ((UNITS, WIDTH), (UNITS, WIDTH), (2, WIDTH), (UNITS,))

    def __init__(self, flat: np.ndarray):
        cuts = np.cumsum([np.prod(s) for s in self.SHAPES])[:-1]
        self.parts = [p.reshape(s).astype(np.float32) for p, s in zip(np.split(flat, cuts), self.SHAPES, strict=True)]
        self.slope = [np.full_like(p, 1e-2) for p in self.parts]

    @classmethod
    def fresh(cls, share: np.ndarray) -> np.ndarray:
        """Parameters that give each unit its share, whatever the context."""
        drawn = np.random.default_rng(0).normal(0, 0.1, 2 * UNITS * WIDTH)
        return np.concatenate([drawn, np.ones(2 * WIDTH), np.log(share)])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts]).astype(np.float64)

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
        """One step: tell the targets from the noise units, which all positions share."""
        context, vector, place, bias = self.parts
        a, b = context[one], context[two]
        q = a * place[0] + b * place[1]
        t, n = vector[target], vector[noise]
        offset = log_noise + np.float32(np.log(len(noise)))
        pull = 1 / (1 + np.exp(np.clip(offset[target] - (q * t).sum(axis=1) - bias[target], -30, 30))) - 1
        push = q @ n.T
        np.subtract(offset[noise], push, out=push)
        push -= bias[noise]
        np.clip(push, -30, 30, out=push)
        np.exp(push, out=push)
        push += 1
        np.divide(1, push, out=push)
        dq = pull[:, None] * t + push @ n
        gradient = [np.zeros_like(p) for p in self.parts]
        both = np.concatenate([one, two])
        self._scatter(gradient[0], both, np.concatenate([dq * place[0], dq * place[1]]))
        self._scatter(gradient[1], target, pull[:, None] * q)
        np.add.at(gradient[1], noise, push.T @ q)
        gradient[2][:] = (dq * a).sum(axis=0), (dq * b).sum(axis=0)
        gradient[3] += np.bincount(target, pull, UNITS) + np.bincount(noise, push.sum(axis=0), UNITS)
        for p, g, s in zip(self.parts, gradient, self.slope, strict=True):
            s += g * g
            p -= RATE * g / np.sqrt(s)

    @staticmethod
    def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        into[rows[first]] += np.add.reduceat(values[order], first, axis=0)

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms of the normalised probabilities of the targets."""
        context, vector, place, bias = self.parts
        both = one.astype(np.int64) * UNITS + two
        there = np.zeros(UNITS * UNITS, bool)
        there[both] = True
        pair = np.flatnonzero(there)
        number = np.zeros(UNITS * UNITS, np.int32)
        number[pair] = np.arange(len(pair), dtype=np.int32)
        of = number[both]
        result, ones = np.empty(len(target)), np.ones(UNITS, np.float32)
        chunk = (of // CONTEXTS).astype(np.int16)
        order = np.argsort(chunk, kind="stable")
        cuts = np.searchsorted(chunk[order], np.arange(-(-len(pair) // CONTEXTS) + 1))
        # The biases are one more place of the vectors, so that the product adds them.
        longer = np.concatenate([vector, bias[:, None]], axis=1).T.copy()
        longest = np.sqrt((vector * vector).sum(axis=1).max())
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            own = pair[k * CONTEXTS : (k + 1) * CONTEXTS]
            q = np.ones((len(own), WIDTH + 1), np.float32)
            q[:, :WIDTH] = context[own // UNITS] * place[0] + context[own % UNITS] * place[1]
            score = q @ longer
            at = order[a:b]
            row = of[at] - k * CONTEXTS
            chosen = score[row, target[at]]
            # No score is further from 0 than this; where its exponential could leave the range, the largest score goes first.
            bound = np.sqrt((q[:, :WIDTH] ** 2).sum(axis=1).max()) * longest + np.abs(bias).max()
            top = np.zeros(len(own), np.float32) if bound < 60 else score.max(axis=1)
            if bound >= 60:
                score -= top[:, None]
            norm = np.log(np.exp(score, out=score) @ ones) + top
            result[at] = chosen - norm[row]
        return result


def _counts(texts: DataFrame) -> DataFrame:
    """word (its key), unit (of the tail) and n of every distinct token."""

    def merge(parts: list[tuple]) -> tuple:
        keys, last, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys)
        keys, last, n = keys[order], last[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], last[first], np.add.reduceat(n, first) if len(first) else n

    def rows(part: tuple) -> pa.RecordBatch:
        keys, last, n = part
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tail_unit(last).astype(np.int32)), pa.array(n)], ["word", "unit", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in blocks(batches, 0):
            keys, last, _ = tokens(batch.column(0))
            parts.append(merge([(keys, last, np.ones(len(keys), np.int64))]))
            if sum(len(p[0]) for p in parts) > 2_000_000:
                parts = [merge(parts)]
                if len(parts[0][0]) > 1_000_000:
                    yield rows(parts.pop())
        if parts:
            yield rows(merge(parts))

    return texts.mapInArrow(count, "word long, unit int, n long").groupBy("word").agg(F.max("unit").alias("unit"), F.sum("n").alias("n"))


def _train(texts: DataFrame, flat: np.ndarray, head: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Parameters after a pass of every task over its own texts, averaged by tokens."""
    shared = texts.sparkSession.sparkContext.broadcast((flat, head, share))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, own_head, noise_share = shared.value
        model, seen = Model(start), 0
        draw = np.random.default_rng(TaskContext.get().partitionId())
        log_noise, ladder = np.log(noise_share).astype(np.float32), np.cumsum(noise_share)
        for batch in blocks(batches, 0):
            keys, last, begins = tokens(batch.column(0))
            unit = units(keys, last, own_head)
            one, two = contexts(unit, begins)
            order = draw.permutation(len(unit))
            for a in range(0, len(unit), STEP):
                at = order[a : a + STEP]
                noise = np.searchsorted(ladder, draw.random(NOISE)).clip(max=UNITS - 1)
                model.step(one[at], two[at], unit[at], noise, log_noise)
            seen += len(unit)
        if seen:
            after = model.flat()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(after), dtype=np.int32)), pa.array(after * seen), pa.array(np.full(len(after), float(seen)))], ["at", "value", "weight"])

    found = texts.mapInArrow(train, "at int, value double, weight double").groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("value")).toArrow()
    result = flat.copy()
    result[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return result


def fit_lm(docs: DataFrame, text_col: str = "text", rounds: int = 1) -> dict:
    """What `score_lm` needs, learned from all rows of `docs`; a null text is an end only.

    `counts` is a checkpointed frame (word, n); everything else is bounded by this module's
    parameters. Without rows every unit is as likely as another.
    """
    shared_dir(docs.sparkSession)
    texts = docs.select(F.col(f"`{text_col}`"))
    counts = _counts(texts).checkpoint()
    # The least count of which the words, with all more frequent ones, are no more than FREQUENT.
    least, more = None, 0
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(FREQUENT).collect():
        more += row.words
        if more > FREQUENT:
            break
        least = row.n
    frequent = counts.where(F.col("n") >= least).toArrow() if least else counts.limit(0).toArrow()
    keys = frequent.column("word").to_numpy().view(np.uint64)
    n = frequent.column("n").to_numpy().astype(np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    ranked = np.lexsort((keys, -n))
    head = np.sort(keys[ranked][keys[ranked] != END_KEY][:HEAD])
    place, there = lookup(keys, head)
    is_head = F.col("word").isin(head.view(np.int64).tolist()) | (F.col("word") == 0)
    tail = counts.where(~is_head).groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total, kinds = np.zeros(UNITS), np.zeros(UNITS)
    total[: len(head)] = n[place]
    for row in tail:
        total[row.unit], kinds[row.unit] = row.n, row.words
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total[END] = whole[0] - total.sum()
    share = (total + 1) / (total + 1).sum()
    flat = Model.fresh(share)
    for _ in range(rounds):
        flat = _train(texts, flat, head, share)
    # A shared unit's words divide its probability; a unit of one word or the end gives it all.
    split = np.where((np.arange(UNITS) >= HEAD) & (np.arange(UNITS) < END), total + ADDED * (kinds + 1), 0.0)
    return {"counts": counts.select("word", "n"), "flat": flat, "head": head, "split": split, "keys": keys, "n": n, "tokens": int(whole[0]), "kinds": int(whole[1])}


def score_lm(docs: DataFrame, fitted: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score (log10) of every row's whole text.

    Tokens are the words between white space and one end; a null or empty text is an end only. Both
    scores give an unseen word the share of a count of ADDED. Every row gives a row, repeated ones
    too; other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({k: fitted[k] for k in ("flat", "head", "split", "keys", "n")})
    all_tokens = fitted["tokens"]
    base_norm = np.log10(all_tokens + ADDED * (fitted["kinds"] + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        model, split = Model(known["flat"]), np.log10(np.where(known["split"] > 0, known["split"], 1.0))
        divided = known["split"] > 0
        row = TaskContext.get().partitionId() << 33
        for batch in blocks(batches, 1, 12 << 20):
            keys, last, begins = tokens(batch.column(1))
            unit = units(keys, last, known["head"])
            one, two = contexts(unit, begins)
            gain = model.log_probabilities(one, two, unit) / np.log(10) - split[unit]
            place, there = lookup(known["keys"], keys)
            count = np.log10(np.where(there, known["n"][place] if len(known["n"]) else 0, 0) + ADDED)
            # Tokens that are not frequent get the logarithm of their count by a join.
            gain += np.where(there & divided[unit], count, 0.0)
            base = np.where(there, count, 0.0) - base_norm
            starts = begins[:-1]
            rest = np.flatnonzero(~there)
            owner = np.searchsorted(begins, rest, "right") - 1
            order = np.lexsort((keys[rest], owner))
            rest, owner = rest[order], owner[order]
            fresh = np.ones(len(rest), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (keys[rest[1:]] != keys[rest[:-1]])
            first = np.flatnonzero(fresh)
            entries = pa.StructArray.from_arrays([pa.array(keys[rest[first]].view(np.int64)), pa.array(np.diff(np.append(first, len(rest))))], ["word", "n"])
            cuts = np.searchsorted(owner[first], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(batch.num_rows)), batch.column(0), pa.array(np.diff(begins)), pa.array(np.add.reduceat(there.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(gain, starts)), pa.ListArray.from_arrays(pa.array(cuts), entries),
                ],
                ["row", "id", "n_tokens", "n_known", "base_score", "score", "rest"],
            )
            row += batch.num_rows

    entry = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])
    kinds = {"row": T.LongType(), "id": docs.schema[id_col].dataType, "n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "rest": T.ArrayType(entry)}
    schema = T.StructType([T.StructField(k, v) for k, v in kinds.items()])
    scored = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(score, schema).checkpoint()
    words = scored.select("row", F.inline("rest")).withColumnRenamed("n", "times")
    seen = F.coalesce("n", F.lit(0))
    found = join_reduced(words, fitted["counts"], ["word"]).groupBy("row").agg(
        F.sum(F.col("times") * F.log10(seen + ADDED)).alias("more"), F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("known")
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("rest").join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
