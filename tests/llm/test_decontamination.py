"""Decontamination against plain alignments of every document with every item."""

import random

import numpy as np
import pytest
from brute import local_alignment, words
from conftest import DATA, prose

from linkloom.llm import decontamination as op
from linkloom.llm.queries import QUERIES

ITEM = "item_id bigint, text string"


def test_alignment_cell_by_cell():
    draw = np.random.default_rng(1)
    for _ in range(60):
        item = draw.integers(1, 5, draw.integers(1, 12)).astype(np.uint64)
        grid = draw.integers(0, 5, (4, draw.integers(1, 20))).astype(np.uint64)
        best, end = op.align(item, grid)
        for i in range(4):
            assert best[i] == local_alignment(list(item), list(grid[i]))
            assert local_alignment(list(item), list(grid[i][: end[i] + 1])) == best[i]


def test_query_finds_exact_and_edited_copies(spark, rows):
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in QUERIES["op7_decontamination"](spark, DATA).collect()}
    items = [r.asDict() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = {}
    for item in items:
        own = words(item["text"])
        for d in rows:
            text = words(d["text"])
            # Only documents that share a run of three words can align that well here.
            if {*zip(own, own[1:], own[2:])} & {*zip(text, text[1:], text[2:])}:
                score = local_alignment(own, text) / (2 * len(own))
                if score >= op.LEAST_SCORE:
                    want[d["doc_id"], item["item_id"]] = score
    assert want and got == pytest.approx(want)


def _edited(item: list[str], rate: float, seed: int) -> str:
    draw = random.Random(seed)
    out = []
    for w in item:
        kind = draw.random()
        if kind < rate / 3:
            continue
        out.append(f"new{draw.random()}" if kind < rate * 2 / 3 else w)
        if rate * 2 / 3 <= kind < rate:
            out.append("put in")
    return " ".join(out)


def test_a_leak_into_a_third_of_all_documents_keeps_its_seeds(spark):
    item = prose(77, 40)
    docs = [(i, f"{prose(1000 + i, 60)} {_edited(item.split(), 0.02 * (i % 10), i) if i % 3 == 0 else ''} {prose(3000 + i, 60)}") for i in range(120)]
    clean = "the of and to in a is that it for was on are as with his they at be this"
    docs += [(1000, f"{clean} {clean}"), (1001, item)]
    items = [(1, item), (2, clean + " " + prose(5, 20)), (3, prose(6, 30)), (4, "too short to say"), (5, None), (6, item)]
    found = op.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    leaked = {i for i in range(0, 120, 3)} | {1001}
    assert got - {(1000, 2)} == {(i, k) for i in leaked for k in (1, 6)}


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_blocks_of_the_benchmark_give_the_same(spark, documents, block_bytes):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").limit(8)
    few = documents.where("doc_id < 60")
    one = sorted(map(tuple, op.decontaminate(few, items).collect()))
    assert sorted(map(tuple, op.decontaminate(few, items, block_bytes * 20).collect())) == one


def test_awkward(spark, awkward, nothing, tmp_path):
    items = spark.createDataFrame([(1, prose(2, 30)), (None, prose(3, 30)), (2, ""), (3, None)], ITEM)
    got = {(r["doc_id"], r["item_id"], r["first_word"], r["last_word"]) for r in op.decontaminate(awkward, items).collect()}
    assert got == {(8, 1, 0, 29), (8, None, 0, 29)}
    assert op.decontaminate(nothing, items).count() == op.decontaminate(awkward, items.limit(0)).count() == 0
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    stay = op.decontamination_stage(spark, awkward, str(tmp_path))
    assert stay.columns == awkward.columns
    assert sorted((r["doc_id"] for r in stay.collect()), key=str) == sorted([1, 2, 3, 4, 5, 5, 6, 7, 9, 10, None, None], key=str)
    assert op.decontamination_stage(spark, nothing, str(tmp_path)).count() == 0


def _regular(item: list[str], kind: str, every: int) -> str:
    """``item`` with every so many words replaced, left out or followed by another."""
    out = []
    for i, w in enumerate(item, 1):
        out += {"replace": [f"new{i}"], "leave": [], "insert": [w, f"new{i}"]}[kind] if i % every == 0 else [w]
    return " ".join(out)


def test_copies_with_many_edits_are_those_of_full_alignment(spark):
    texts = {i: prose(40 + i, 16 + 4 * i) for i in range(1, 8)}
    copies = []
    for i in (1, 2, 3):  # one copy each: every third or fourth word replaced, or a word put in after each
        copies += [(i, _regular(texts[i].split(), *(("replace", 4), ("replace", 3), ("insert", 1))[i - 1]))]
    for i in (4, 5):  # an edited copy beside verbatim ones
        copies += [(i, _regular(texts[i].split(), "replace", i - 1))] + [(i, texts[i])] * 6
    draw = random.Random(5)
    copies += [(i, _edited(texts[i].split(), draw.uniform(0.2, 0.5), n)) for n in range(40) for i in (6, 7)]
    copies += [(1, _regular(texts[1].split(), "leave", 3)), (2, " ".join(reversed(texts[2].split())))]
    docs = [(n, f"{prose(2000 + n, 30)} {text} {prose(4000 + n, 50)}") for n, (_, text) in enumerate(copies)]
    want = {}
    for n, text in docs:
        for i, item in texts.items():
            score = local_alignment(words(item), words(text)) / (2 * len(words(item)))
            if score >= op.LEAST_SCORE:
                want[n, i] = score
    assert {(n, copies[n][0]) for n in range(17)} <= want.keys() and len(want) < len(docs)
    found = op.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(texts.items()), ITEM))
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()} == pytest.approx(want)


def test_one_edited_copy_alone_in_the_corpus(spark):
    item = prose(78, 24)
    docs = [(1, f"{prose(1, 60)} {_regular(item.split(), 'replace', 4)} {prose(2, 60)}"), (2, prose(3, 90))]
    found = op.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, item)], ITEM))
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 1)]
