"""Toxicity of texts by subword-bag embeddings averaged into a linear softmax.

The words of a text, runs of letters in lower case between marks of their borders, are bags of runs of three to
six bytes, hashed into buckets. The mean of the vectors of a bag goes through a linear layer with two
classes; vectors and layer are trained together by stochastic gradient descent in numpy. An unseen misspelling or
inflection shares most of its runs with a word that was seen.

A few words make a text toxic, however long it is, so a mean over all of it would lose them. Bags are therefore
passages of ``PASSAGE`` words, each beginning ``STRIDE`` words after the one before, over the whole text, and a text is
as toxic as its most toxic passage. Training does likewise: after some steps with the whole of it, a text
teaches its most toxic passage, of whichever class.

Learned are at most ``PER_CLASS`` labelled documents of each class with texts of ``SAMPLE_BYTES`` or less, chosen by a hash of
their id and length. A fifth of them is set aside, on which a logistic curve is fitted that turns the passage's logit into a probability.

Defined results: a null or empty text, or one without letters, has no passage and scores like the evidence of none,
at most 0.5. Rows with a null id are never trained on and count as not held out. Documents without label or with a null label are scored
only; an id labelled both ways, or twice, is learned as toxic once. Other rows that repeat an id are learned and scored by themselves.
If there are no labelled documents of both classes, every score is 0. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import attach, ship_package, table, written
from linkloom.llm.words import batches_by_bytes, mix, text_bytes

PER_CLASS = 1_500
SAMPLE_BYTES = 6_000
BUCKETS = 1 << 16
DIMENSIONS = 8
LENGTHS = (3, 4, 5, 6)
PASSAGE, STRIDE = 3, 1
# A word of more subwords counts as if it had this many, so that it does not outweigh its neighbours.
WORD_SUBWORDS = 48.0
STEPS = 10_000
# The share of steps that learn from a whole text; the others learn from its most toxic passage.
WHOLE_TEXTS = 0.3
RATE = 0.5
# The largest change of a logit by one step, as a multiple of the error.
MOST_MOVED = 4.0
LEAST_TOXIC = 0.7
SLICE_BYTES = 1 << 18
_BORDER = 0x20

# Letters: A to Z in either case, and all bytes of characters beyond ASCII.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Model:
    """Logit of toxic against not for each bucket, its bias, and the curve from logits to probabilities; no buckets if nothing is known."""

    logits: np.ndarray
    bias: float
    slope: float
    offset: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lowered(texts: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text in lower case."""
    data, offsets = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    for low, high in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[low:high]


@dataclass(frozen=True)
class Bags:
    """Buckets of the subwords of words in their order; the subwords of word ``i`` are ``bounds[i]:bounds[i + 1]``."""

    buckets: np.ndarray
    bounds: np.ndarray

    def weights(self) -> np.ndarray:
        """One for each subword, but for those of very long words, which share what ``WORD_SUBWORDS`` have."""
        sizes = np.diff(self.bounds)
        return np.repeat(np.minimum(1.0, WORD_SUBWORDS / np.maximum(1, sizes)), sizes)

    def passages(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds within ``buckets`` of each passage and the weighted mean of ``values`` in it.

        Fewer words than a passage has are one passage.
        """
        words = len(self.bounds) - 1
        first = np.arange(0, max(1, words - PASSAGE + STRIDE), STRIDE) if words else np.zeros(0, dtype=np.int64)
        last = np.minimum(first + PASSAGE, words)
        weights = self.weights()
        sums = np.concatenate([[0.0], np.cumsum(values * weights)])
        total = np.concatenate([[0.0], np.cumsum(weights)])
        low, high = self.bounds[first], self.bounds[last]
        return low, high, (sums[high] - sums[low]) / (total[high] - total[low])


def bags_of(text: np.ndarray) -> Bags:
    """Subwords of the words in the bytes of a text in lower case."""
    letter = np.concatenate([[False], _LETTER[text], [False]])
    marked = np.where(letter, np.concatenate([[_BORDER], text, [_BORDER]]), _BORDER).astype(np.uint64)
    before = np.cumsum(letter)  # letters up to and with each place
    starts = np.flatnonzero(letter[1:] & ~letter[:-1])  # the border in front of each word
    places, buckets = [], []
    for n in LENGTHS:
        if len(marked) < n:
            continue
        count = len(marked) - n + 1
        # All bytes but the first and the last must be letters of one word.
        inner = before[n - 2 : n - 2 + count] - before[:count]
        here = np.flatnonzero(inner == n - 2)
        key = np.full(len(here), n, dtype=np.uint64)
        for i in range(n):
            key = key * np.uint64(0x100000001B3) + marked[here + i]
        places.append(here)
        buckets.append((mix(key) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    place = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
    bucket = np.concatenate(buckets) if buckets else np.zeros(0, dtype=np.int32)
    # A run that begins at a word's own border, or at one of its letters, belongs to it.
    word = np.searchsorted(starts, place, "right") - 1
    order = np.argsort(word, kind="stable")
    return Bags(bucket[order], np.searchsorted(word[order], np.arange(len(starts) + 1)))


def pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A text in slices that end between words, each beginning with the last ``PASSAGE`` words of the one before."""
    low = 0
    while True:
        high = low + SLICE_BYTES
        if high >= len(text):
            yield text[low:]
            return
        while high < len(text) and _LETTER[text[high]]:
            ends = np.flatnonzero(~_LETTER[text[high : high + SLICE_BYTES]])
            high = high + int(ends[0]) if len(ends) else min(high + SLICE_BYTES, len(text))
        yield text[low:high]
        if high >= len(text):
            return
        letter = _LETTER[text[low:high]]
        starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
        # Far enough on that slices advance, however few words there are.
        back = int(starts[-PASSAGE]) if len(starts) >= PASSAGE else len(letter)
        low = low + back if back > len(letter) // 2 else high


def best_passage(logits: np.ndarray, bags: Bags) -> float:
    """The logit of the most toxic passage, without bias; minus infinity without words."""
    return float(bags.passages(logits[bags.buckets])[2].max(initial=-np.inf))


def strongest(model: Model, text: np.ndarray) -> float:
    """The logit of the most toxic passage of a whole text; minus infinity without words."""
    best = -np.inf
    for piece in pieces(text):
        best = max(best, best_passage(model.logits, bags_of(piece)))
    return best + model.bias


def probability(model: Model, logit: float) -> float:
    if len(model.logits) == 0:
        return 0.0
    if logit == -np.inf:  # no words: what the curve gives to no evidence
        logit = min(model.bias, -model.offset / model.slope)
    return float(1 / (1 + np.exp(-np.clip(model.slope * logit + model.offset, -500, 500))))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``toxic, place, text``: at most ``per_class`` learnable documents of each class, by a hash of the id and length."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    marks = written(marks.where(~held_out(F.col("doc_id"))), "marks")
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES))
    rows = rows.withColumn("place", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 40)))
    keys = attach(rows.select("doc_id", "place"), marks, ["doc_id"], spread_by=["place"])
    keys = written(keys, "learnable")
    # Per class, the hash below which about as many documents lie as are wanted; at most that many are then taken.
    cuts = keys.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"))
    share = {r["toxic"]: min(1.0, 1.3 * per_class / r["rows"] + 20 / r["rows"]) for r in cuts.collect()}  # two classes
    chosen = None
    for toxic, part in sorted(share.items()):
        here = keys.where((F.col("toxic") == toxic) & (F.col("place") < int(part * (1 << 40)))).orderBy("place", "doc_id").limit(per_class)
        chosen = here if chosen is None else chosen.unionByName(here)
    if chosen is None:
        return keys.withColumn("text", F.lit("")).select("toxic", "place", "text").limit(0)
    chosen = written(chosen.distinct(), "learned")
    return rows.join(F.broadcast(chosen), ["doc_id", "place"]).select("toxic", "place", "text")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 1) -> Model:
    """A model of the labelled rows of ``docs(doc_id, text)`` by ``labels(doc_id, toxic)`` that are not held out."""
    ship_package(docs.sparkSession)
    rows = sample(docs, labels, per_class).toArrow().combine_chunks()  # bounded: 2 * per_class * SAMPLE_BYTES
    rows = rows.sort_by([("place", "ascending"), ("text", "ascending"), ("toxic", "ascending")])
    target = rows.column("toxic").to_numpy().astype(np.int64)
    if len(set(target.tolist())) < 2:
        return Model(np.zeros(0, dtype=np.float32), 0.0, 1.0, 0.0)
    bags = [bags_of(text) for text in lowered(rows.column("text").combine_chunks())]
    learn = np.array([len(b.buckets) > 0 for b in bags])
    aside = np.zeros(len(target), dtype=bool)
    for k in (0, 1):  # a fifth of each class
        aside[np.flatnonzero(target == k)[4::5]] = True
    logits, bias = _descend(bags, target, np.flatnonzero(learn & ~aside), seed)
    check = np.flatnonzero(learn & aside)
    if len(set(target[check].tolist())) < 2:
        check = np.flatnonzero(learn)
    best = np.array([best_passage(logits, bags[i]) + bias for i in check])
    return Model(logits, bias, *_curve(best, target[check]))


def _descend(bags: list[Bags], target: np.ndarray, train: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent on vectors and layer; classes have the same weight."""
    draw = np.random.default_rng(seed)
    # Vectors begin small: a run that was never seen speaks for neither class.
    vectors = draw.normal(0, 0.02, (BUCKETS, DIMENSIONS))
    layer, bias = draw.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    # Both classes have the same number of turns, so that the rarer one goes round more often.
    rounds = [[draw.permutation(train[target[train] == k]) for _ in range(1 + STEPS // (2 * max(1, (target[train] == k).sum())))] for k in (0, 1)]
    order = np.column_stack([np.concatenate(r)[: STEPS // 2] for r in rounds]).ravel()
    for done, i in enumerate(order):
        rate = RATE * (1 - done / len(order))
        one, part = bags[i], slice(None)
        if len(one.buckets) == 0:
            continue
        if done >= WHOLE_TEXTS * len(order):
            low, high, means = one.passages(vectors[one.buckets] @ (layer[:, 1] - layer[:, 0]))
            at = int(np.argmax(means))
            part = slice(low[at], high[at])
        weights = one.weights()[part]
        subwords, place = np.unique(one.buckets[part], return_inverse=True)
        counts = np.bincount(place, weights) / weights.sum()
        mean = counts @ vectors[subwords]
        error = _softmax(mean @ layer + bias)
        error[target[i]] -= 1
        back = layer @ error
        # A bag's mean has a small share of each vector, so vectors take larger steps; no step moves a logit too far.
        step = min(40 * rate, MOST_MOVED / max(1e-12, float(counts @ counts) * float((layer**2).sum())))
        layer -= min(rate, MOST_MOVED / max(1e-12, float(mean @ mean))) * np.outer(mean, error)
        bias -= 0.1 * rate * error
        vectors[subwords] -= step * np.outer(counts, back)
    gap = layer[:, 1] - layer[:, 0]
    return (vectors @ gap).astype(np.float32), float(bias[1] - bias[0])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def _curve(logits: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method; a small ridge keeps parted classes finite."""
    x = np.column_stack([logits, np.ones(len(logits))])
    weight = len(target) / (2 * np.maximum(1, np.bincount(target, minlength=2)))[target]
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        ridge = np.array([0.02, 0.02])
        slope = x.T @ (weight * (p - target)) + ridge * at
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(bend, slope)
        at = at - step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                found = [
                    probability(model, strongest(model, text) if len(model.logits) else -np.inf) for text in lowered(batch.column("text"))
                ]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; learned from rows that are not held out."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = scores(docs, fit(docs, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"), per_class))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LEAST_TOXIC).cast("int").alias("predicted"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
