import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import awkward_rows
from linkloom.llm import toxicity as t

LABELS = "doc_id bigint, quality int, toxic int"


def words(text: str) -> list[bytes]:
    """Runs of letters of a text in lower case, one character at a time."""
    out, run = [], b""
    for c in text.lower() + " ":
        if c.isascii() and not c.isalpha():
            if run:
                out.append(run)
            run = b""
        else:
            run += c.encode()
    return out


def brute_logit(model: t.Model, text: str) -> float:
    """The best mean over passages, subword by subword."""
    found = words(text)
    best = -np.inf
    for first in range(max(1, len(found) - t.PASSAGE + 1) if found else 0):
        total, size = 0.0, 0.0
        for word in found[first : first + t.PASSAGE]:
            marked, bag = b" " + word + b" ", []
            for n in t.LENGTHS:
                for i in range(len(marked) - n + 1):
                    bag.append(model.logits[_bucket(marked[i : i + n])])
            weight = min(1.0, t.WORD_SUBWORDS / len(bag))
            total, size = total + weight * float(np.sum(np.array(bag, dtype=np.float64))), size + weight * len(bag)
        best = max(best, total / size)
    return best + model.bias


def _bucket(run: bytes) -> int:
    key = len(run)
    for byte in run:
        key = (key * 0x100000001B3 + byte) % (1 << 64)
    from linkloom.llm.words import mix

    with np.errstate(over="ignore"):
        return int(mix(np.array([key], dtype=np.uint64))[0] >> np.uint64(64 - 16))


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark, folder):
    return t.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def score(model, text: str) -> float:
    return t.probability(model, t.strongest(model, next(t.lowered(pa.array([text])))))


def test_held_out_documents(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = t.op12_toxicity(spark, folder)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    found = rows.collect()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    unseen = [(toxic[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in toxic]
    hit = sum(a and b for a, b in unseen)
    # Only 275 toxic documents to learn from; with a thousand nearly all are found and nothing else.
    assert len(unseen) > 1000 and hit >= 0.85 * sum(a for a, _ in unseen) and hit >= 0.85 * sum(b for _, b in unseen)


def test_scores_equal_brute_force(documents, model):
    for row in documents.where("length(text) < 2000").limit(40).collect():
        text = next(t.lowered(pa.array([row.text])))
        assert t.strongest(model, text) == pytest.approx(brute_logit(model, row.text), abs=1e-5)


def test_inflected_words_are_found(model):
    clean = "the thing was on and the other in that er of this"
    assert score(model, clean) < 0.3
    for word in ("idiots", "moronic", "worthlessness", "Patheticc", "STUPIDD", "clowns"):
        assert score(model, f"{clean} {word} {clean}") >= 0.5, word


def test_long_texts_are_read_to_the_end(model, monkeypatch):
    clean = "the thing was on and the other in that er of this " * 400
    late = clean + "idiot moron " + clean
    whole = score(model, late)
    assert score(model, clean) < 0.3 and whole >= 0.7
    for size in (64, 1000, 20_011):
        monkeypatch.setattr(t, "SLICE_BYTES", size)
        assert score(model, late) == pytest.approx(whole)
        assert score(model, "x" * 5000 + " idiot moron") >= 0.7


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(1, 11)] + [(4, 1, 1), (None, 1, 1), (6, 1, None)], LABELS)
    labels = labels.withColumns({c: F.lit("own") for c in ("score", "place", "text", "_slice")})
    found = t.toxicity(awkward, labels).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r[0]) for r in awkward_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    empty = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and max(empty) <= 0.5
    assert t.toxicity(nothing, labels).collect() == []
    unlabelled = t.toxicity(awkward, labels.limit(0)).collect()
    assert len(unlabelled) == len(found) and {r.score for r in unlabelled} == {0.0}


def test_sample_is_bounded_and_blind_to_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(600)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(600)], LABELS)
    rows = t.sample(docs, labels, 50).collect()
    assert sorted(r.toxic for r in rows) == [0] * 50 + [1] * 50
    assert all(zlib.crc32(r.text.split()[1].encode()) % 3 != 1 for r in rows)
