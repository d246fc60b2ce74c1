"""Language identification by held-out accuracy, and its rules."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA

from linkloom.llm import language_id as op
from linkloom.llm.queries import QUERIES


def test_query_on_held_out_documents(spark, rows):
    got = {r["doc_id"]: r for r in QUERIES["op10_language_id"](spark, DATA).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {r["doc_id"] for r in held} and len(held) > 20
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) >= 0.97
    for r in rows:
        known = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert (got[r["doc_id"]]["lang_pred"] == "und") == (not known) and 0 <= got[r["doc_id"]]["score"] <= 1
    assert np.mean([r["accepted"] for r in got.values()]) > 0.98


def test_labels_of_held_out_rows_are_never_used(spark, documents):
    from pyspark.sql import functions as F

    false = documents.withColumn("lang", F.when(op.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    one, other = op.fit(documents, 40), op.fit(false, 40)
    assert one.languages == other.languages and np.array_equal(one.table, other.table)


def test_sample_is_bounded(documents):
    counts = op.training_counts(documents, 7).groupBy("lang").count().collect()
    assert counts and all(r["count"] <= 7 for r in counts)


def test_slices_of_a_long_text_count_like_the_whole():
    text = np.frombuffer(("abc défg " * 90_000).encode(), dtype=np.uint8)
    whole = sum(np.bincount(op.subword_buckets(text, n), minlength=op.BUCKETS) for n in op.LENGTHS)
    assert len(list(op.text_slices(text))) > 2 and np.array_equal(op.bucket_counts(text), whole)
    assert np.array_equal(op.bucket_counts(text[:0]), np.zeros(op.BUCKETS))


def test_awkward(awkward, nothing):
    got = op.language_id(awkward).collect()
    assert len(got) == awkward.count()
    for r in got:
        if r["doc_id"] in (1, 2, 3, 10):
            assert r["lang_pred"] == "und" and r["score"] == 0 and not r["accepted"]
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr")
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert op.language_id(nothing).count() == 0


def test_nothing_labelled(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in op.predict(docs, op.fit(docs)).collect()] == [(1, "und", 0.0, False)]


def test_stage_keeps_clean_documents(spark, documents, awkward, nothing):
    got = op.language_id_stage(spark, documents, DATA)
    assert got.columns == documents.columns
    with_letters = [r["doc_id"] for r in documents.collect() if re.search(r"[^\W\d_]", r["text"] or "")]
    assert got.count() >= 0.99 * len(with_letters)
    stay = op.language_id_stage(spark, awkward, DATA)
    assert stay.columns == awkward.columns
    assert {r["doc_id"] for r in stay.collect()}.isdisjoint({1, 2, 3, 10})
    assert op.language_id_stage(spark, nothing, DATA).count() == 0


def test_lowered_keeps_other_letters():
    assert [bytes(x) for x in op.lowered(pa.array(["AbÉ", None, ""]))] == ["abÉ".encode(), b"", b""]


def _spoken(letters: str, vowels: str, seed: int, n: int = 60) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) + draw.choice(vowels) for _ in range(draw.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("learned", [1, 2])
def test_unlearned_languages_and_junk_are_rejected(spark, learned):
    kinds = [("aa", "bdgl", "ae"), ("bb", "kmpt", "iou")]
    docs = [(1000 * k + i, _spoken(c, v, 1000 * k + i), lang) for k, (lang, c, v) in enumerate(kinds[:learned]) for i in range(200)]
    clean = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = op.fit(clean)
    assert all(r["accepted"] for r in op.predict(clean, model).collect())
    others = [_spoken("cfrsz", "yw", 5), _spoken("вгдж", "аои", 6), "xqzv kjwq zzxq " * 20, "x" * 600, _spoken("\u4e00\u4e8c", "\u4e09", 7)]
    strange = spark.createDataFrame([(i, t, None) for i, t in enumerate(others)], clean.schema)
    assert not any(r["accepted"] for r in op.predict(strange, model).collect())


def test_a_sample_too_small_to_tell_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "one short text", "aa"), (2, "ein kurzer Text", "bb"), (7, "quite other words", None)], "doc_id bigint, text string, lang string")
    assert all(r["accepted"] for r in op.predict(docs, op.fit(docs)).collect())
