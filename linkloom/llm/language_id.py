"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of two, three and four bytes of a text, hashed into buckets; a text is the mean of
its subwords' vectors, from which a linear layer gives one logit per language. Vectors and
layer are trained together by stochastic gradient descent in numpy, on a bounded sample:
``PER_LANGUAGE`` labelled documents of each language, whole texts, chosen by a hash of their id.
A tenth of the sample is set aside to calibrate: a temperature that makes probabilities
honest, and a score below which a text is rejected.

As a softmax has to choose among what it knows, its score cannot tell a text of another language. So each language also
has the shares of its subwords' buckets, and a text is rejected if under every language its subwords are less likely
than buckets at random, by more than chance in a few of them. Where more than a hundredth of the sample's texts of a language, each
against the others, would go, its limit is lowered until they stay. A language with few texts has no limit: what is taken for it is accepted.

Predicting needs one look-up per subword, as the vectors times the layer are one table of
languages by buckets; texts of any length go through in slices.

Defined results: a text that is null or has no letter is ``und`` with score 0 and rejected.
Rows with a null id are never trained on and count as held out. Rows without label
are predicted like all others. If nothing is labelled, every text is ``und``. Ties go to the language first in
alphabetical order. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import columns, ship_package, table, written
from linkloom.llm.words import batches_by_bytes, text_bytes

UNKNOWN = "und"
PER_LANGUAGE = 600
BUCKETS = 1 << 13
DIMENSIONS = 16
EPOCHS = 8
RATE = 1.0
LENGTHS = (2, 3, 4)
SLICE_BYTES = 1 << 18
# Share of the calibration documents, beyond the worst of each hundred, that a rejected text scores below.
SLACK = 0.5
# Share of each language's subwords that may be any, and the logarithm of likelihood that is taken for chance in a text.
UNSEEN = 0.05
EVIDENCE = 20.0
# Texts of a language that its limit needs, and a limit below every likelihood.
LIMIT_TEXTS = 20
NO_LIMIT = -100.0


@dataclass(frozen=True)
class Model:
    """Languages in order, logits of each bucket, biases, temperature and the least accepted score; log likelihood
    of each bucket against one at random, and the least accepted mean of it in each language."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float
    likely: np.ndarray
    least_likely: np.ndarray


def subword_buckets(data: np.ndarray, length: int) -> np.ndarray:
    """The bucket of each run of ``length`` bytes."""
    n = max(0, len(data) - length + 1)
    out = np.full(n, length, dtype=np.uint32)
    for i in range(length):
        out = out * np.uint32(0x01000193) ^ data[i : i + n]
    out = (out ^ (out >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (out >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def text_slices(text: np.ndarray) -> Iterator[np.ndarray]:
    """Slices of a text whose runs of bytes together are the runs of the whole."""
    overlap = max(LENGTHS) - 1
    for low in range(0, max(1, len(text)), SLICE_BYTES):
        yield text[max(0, low - overlap) : low + SLICE_BYTES]


def slice_buckets(piece: np.ndarray, first: bool) -> np.ndarray:
    """Buckets of the runs that end in this slice and not in the one before."""
    overlap = 0 if first else max(LENGTHS) - 1
    return np.concatenate([subword_buckets(piece[max(0, overlap - n + 1) :], n) for n in LENGTHS])


def bucket_counts(text: np.ndarray) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for i, piece in enumerate(text_slices(text)):
        counts += np.bincount(slice_buckets(piece, i == 0), minlength=BUCKETS)
    return counts


def lowered(texts: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text, A to Z in lower case."""
    data, offsets = text_bytes(texts)
    for low, high in zip(offsets[:-1], offsets[1:], strict=True):
        yield np.frombuffer(data[low:high].tobytes().lower(), dtype=np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_counts(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, buckets, counts`` of at most ``per_language`` documents of each language, chosen by a hash of the id."""
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & has_letter(F.col("text")))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    # A hash below this share of its range leaves about half as many rows again; the rest are cut by rank.
    share = F.least(F.lit(1.0), 1.5 * per_language / F.col("docs"))
    # Rows with the same id are told apart by their text; those equal in both are the same to the model.
    order = F.xxhash64("doc_id", "text")
    place = F.pmod(order, F.lit(1 << 30)) / (1 << 30)
    chosen = labelled.withColumn("order", order).withColumn("place", place)
    chosen = chosen.join(F.broadcast(sizes), "lang").where(F.col("place") < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = [], []
            for text in lowered(batch.column("text")):
                found = bucket_counts(text)
                buckets.append(np.flatnonzero(found).astype(np.int32))
                counts.append(found[buckets[-1]].astype(np.float32) / max(1, found.sum()))
            arrays = [batch.column("lang"), batch.column("order"), pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "order", "buckets", "counts"])

    kinds = "lang string, order bigint, buckets array<int>, counts array<float>"
    counted = written(chosen.select("lang", "order", "text").mapInArrow(count, kinds), "language-sample")
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 1) -> Model:
    """A model of the labelled rows of ``docs(doc_id, text, lang)``."""
    ship_package(docs.sparkSession)
    rows = training_counts(docs, per_language).orderBy("order", "lang").select("lang", "buckets", "counts").toArrow()
    names = rows.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    if not languages:
        return Model((), np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0, 0.0, np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    target = np.array([languages.index(x) for x in names])
    # Slices of the collected arrays, not copies: the sample is the largest thing the driver holds.
    features = [(b.values.to_numpy(), c.values.to_numpy()) for b, c in zip(rows.column("buckets"), rows.column("counts"), strict=True)]
    aside = np.arange(len(names)) % 10 == 9
    if aside.sum() < len(languages):
        aside[:] = False
    vectors, layer, bias = _descend(features, target, np.flatnonzero(~aside), len(languages), seed)
    logits = np.array([(c @ vectors[b]) @ layer + bias for b, c in features])
    check = aside if aside.any() else ~aside
    temperature = _temperature(logits[check], target[check])
    best = _softmax(logits[check] / temperature).max(axis=1)
    # Nothing of the kind that was learned should be rejected: half of what its worst hundredth scores,
    # and no more than a little above chance.
    chance = 1 / len(languages)
    least = min(SLACK * float(np.quantile(best, 0.01)), chance + 0.1 * (1 - chance))
    return Model(languages, np.ascontiguousarray((vectors @ layer).T.astype(np.float32)), bias, temperature, least, *_likelihoods(features, target, len(languages)))


def _likelihoods(features, target, classes) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each bucket in each language against one at random, and the mean that a text of it has to reach."""
    sums, docs = np.zeros((classes, BUCKETS)), np.bincount(target, minlength=classes)
    for i, (buckets, counts) in enumerate(features):
        sums[target[i], buckets] += counts
    likely = np.log((1 - UNSEEN) * BUCKETS * sums / docs[:, None] + UNSEEN)
    means = []
    for i, (buckets, counts) in enumerate(features):
        # Against all texts of its language but this one.
        rest = np.maximum(0, sums[target[i], buckets] - counts) / max(1, docs[target[i]] - 1)
        means.append(np.log((1 - UNSEEN) * BUCKETS * rest + UNSEEN) @ counts)
    means = np.array(means)
    least = [min(0.0, float(np.quantile(means[target == k], 0.01))) if docs[k] >= LIMIT_TEXTS else NO_LIMIT for k in range(classes)]
    return likely.astype(np.float32), np.array(least)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _descend(features, target, train, classes, seed):
    """Stochastic gradient descent with a falling rate on vectors, layer and bias."""
    draw = np.random.default_rng(seed)
    vectors = draw.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = draw.normal(0, 0.5, (DIMENSIONS, classes)), np.zeros(classes)
    steps, done = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(train):
            buckets, counts = features[i]
            rate, done = RATE * (1 - done / steps), done + 1
            if len(buckets) == 0:
                continue
            mean = counts @ vectors[buckets]
            error = _softmax(mean @ layer + bias)
            error[target[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            vectors[buckets] -= (20 * rate) * np.outer(counts, back)
    return vectors, layer, bias


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the smallest loss on documents set aside."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))
    picked = np.arange(len(target))
    losses = [-np.log(_softmax(logits / t)[picked, target] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of every row of ``docs``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                letters = batch.column("letters").to_numpy(zero_copy_only=False)
                names, scores, taken = [], [], []
                for text, known in zip(lowered(batch.column("text")), letters, strict=True):
                    taken.append(False)
                    if not known or not model.languages:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    share, accepted = _judged(model, text)
                    best = int(np.argmax(share))
                    names.append(model.languages[best])
                    scores.append(float(share[best]))
                    taken[-1] = accepted
                arrays = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(taken, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "accepted"])

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), has_letter(text).alias("letters"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, accepted boolean")


def _judged(model: Model, text: np.ndarray) -> tuple[np.ndarray, bool]:
    """Probability of each language, and whether the text is accepted as of any."""
    total, likelihood, seen = np.zeros(len(model.languages)), np.zeros(len(model.languages)), 0
    for i, piece in enumerate(text_slices(text)):
        buckets = slice_buckets(piece, i == 0)
        seen += len(buckets)
        if len(buckets) > BUCKETS:
            counts = np.bincount(buckets, minlength=BUCKETS).astype(np.float32)
            total += model.table @ counts
            likelihood += model.likely @ counts
        else:
            total += [row[buckets].sum(dtype=np.float64) for row in model.table]
            likelihood += [row[buckets].sum(dtype=np.float64) for row in model.likely]
    share = _softmax((total / max(1, seen) + model.bias) / model.temperature)
    enough = likelihood >= model.least_likely * seen - EVIDENCE
    # A language without a limit speaks for what is taken for it only.
    enough[(model.least_likely == NO_LIMIT) & (np.arange(len(share)) != share.argmax())] = False
    return share, bool(share.max() >= model.least_score and enough.any())


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Fit on the labelled rows of ``docs`` that are not held out; predict every row."""
    return predict(docs, fit(docs, per_language)).withColumn("held_out", held_out(F.col("doc_id")))


def language_id_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the texts that are rejected: no letter, or less like every learned language than chance allows.

    Rows are filtered where they are read; nothing is shuffled and rows without id are treated like others.
    """
    model = fit(docs)
    sent = spark.sparkContext.broadcast(model)
    schema = docs.schema
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                known = batch.column("letters").to_numpy(zero_copy_only=False)
                stay = [
                    bool(k) and bool(model.languages) and _judged(model, text)[1]
                    for text, k in zip(lowered(batch.column("text")), known, strict=True)
                ]
                kept = batch.filter(pa.array(stay, pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns[:-2], schema=pa.schema([f.with_name(n) for f, n in zip(kept.schema, schema.names)]))

    # Python functions take no column names with certain characters, so columns go by their number.
    numbered = [c.alias(f"column_{i}") for i, c in enumerate(columns(docs))]
    return docs.select(*numbered, F.col("text"), has_letter(F.col("text")).alias("letters")).mapInArrow(keep, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "accepted")
