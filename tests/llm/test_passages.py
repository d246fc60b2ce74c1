"""Passages: exact ones are always found, edited ones mostly, clean documents never."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import lowered, repeated_words
from conftest import DATA, prose

from linkloom.llm import passages as op
from linkloom.llm.queries import QUERIES

KINDS = "doc_id bigint, text string"


def _covered(found) -> dict[int, set[int]]:
    out = {}
    for r in found:
        if not r["whole_copy"]:
            out.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["first_word"] + r["n_words"]))
    return out


def test_windows_are_those_of_the_cartesian_tree():
    draw = np.random.default_rng(0)
    for t in range(150):
        lengths = draw.integers(0, 60, draw.integers(1, 6))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        values = draw.integers(0, 40 if t % 2 else 1 << 62, bounds[-1]).astype(np.uint64)
        width, want = int(draw.integers(1, 12)), set()

        def grow(low, high, values=values, width=width, want=want):
            if high - low >= width:
                root = low + int(np.argmin(values[low:high]))
                want.add((root, int(low), int(high - 1)))
                grow(low, root)
                grow(root + 1, high)

        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            grow(low, high)
        assert set(zip(*(x.tolist() for x in op.compact_windows(values, bounds, width)), strict=True)) == want


@pytest.mark.parametrize("parts", ["1", "8"])
def test_query_covers_every_exact_passage(spark, rows, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = QUERIES["op1_passages"](spark, DATA).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    covered, need = _covered(got), repeated_words(rows)
    assert need and all(need[i] <= covered.get(i, set()) for i in need)
    assert all(r["n_words"] >= 50 and r["similarity"] >= 0.8 and r["match_doc_id"] != r["doc_id"] for r in got)
    texts = {}
    for r in rows:
        texts.setdefault(lowered(r["text"]), []).append(r["doc_id"])
    copies = {i for t, ids in texts.items() if len(ids) > 1 and len(t.split()) >= 50 for i in ids}
    assert {r["doc_id"] for r in got if r["whole_copy"]} == copies


def test_one_passage_in_most_documents_and_others_clean(spark):
    common, short = prose(900, 55), prose(901, 30)
    docs = [(i, f"{prose(i, 40 + i % 50)} {common} {prose(5000 + i, 30)}") for i in range(300)]
    docs += [(1000 + i, f"{prose(9000 + i, 60)} {short} {prose(12_000 + i, 60)}") for i in range(200)]
    got = op.repeated_passages(spark.createDataFrame(docs, KINDS)).collect()
    covered = _covered(got)
    assert covered.keys() == set(range(300))
    for i in range(300):
        assert set(range(40 + i % 50, 40 + i % 50 + 55)) <= covered[i] and len(covered[i]) <= 75


def test_edited_passages(spark):
    draw, docs = random.Random(4), []
    for i in range(60):
        passage = prose(100 + i, 120).split()
        edited = passage[:]
        for at in (30, 90):
            if draw.random() < 0.5:
                edited[at] = "other"
            else:
                edited.insert(at, "put")
        docs += [(2 * i, " ".join([prose(7000 + i, 50), *passage])), (2 * i + 1, " ".join([*edited, prose(8000 + i, 50)]))]
    found = _covered(op.repeated_passages(spark.createDataFrame(docs, KINDS)).collect())
    assert len(found) >= 114


def test_one_edit_at_any_place_of_the_shortest_passage(spark):
    docs, want = [], {}
    for at in range(50):
        for kind in range(3):
            passage = prose(20_000 + 3 * at + kind, 50).split()
            edited = [*passage[:at], *([], ["other"], ["other", passage[at]])[kind], *passage[at + 1 :]]
            one = 1000 + 6 * at + 2 * kind
            docs += [(one, " ".join([prose(one, 30), *passage, prose(one + 50_000, 30)])), (one + 1, " ".join([prose(one + 90_000, 30), *edited, prose(one + 70_000, 30)]))]
            want[one] = set(range(30, 80))
    covered = _covered(op.repeated_passages(spark.createDataFrame(docs, KINDS)).collect())
    assert {i: need for i, need in want.items() if not need <= covered.get(i, set())} == {}


@pytest.mark.parametrize(("most", "few"), [(4096, 1000), (4096, 4), (64, 4)])
def test_edited_passages_in_a_crowd_of_the_same_half(spark, monkeypatch, most, few):
    """Texts that sort between two near ones, with the same half a passage and another end, hide neither from the other."""
    monkeypatch.setattr(op, "PART_CLASSES", most)
    monkeypatch.setattr(op, "FEW", few)
    half, draw = prose(31_000, 28).split(), random.Random(8)
    docs, pairs = [], []
    for i in range(40):
        end = prose(32_000 + i, 22).split()
        ends = [end, [draw.choice(["aaa", "mmm", "zzz"]), *end[1:]]]
        for k in (0, 1):
            docs.append((2 * i + k, " ".join([prose(33_000 + 2 * i + k, 40), *half, *ends[k], prose(34_000 + 2 * i + k, 40)])))
        pairs += [2 * i, 2 * i + 1]
    docs += [(1000 + i, " ".join([prose(35_000 + i, 40), *half, prose(36_000 + i, 60)])) for i in range(120)]
    got = op.repeated_passages(spark.createDataFrame(docs, KINDS)).collect()
    covered = _covered(got)
    assert sorted(covered) == pairs and all(set(range(40, 90)) <= covered[i] for i in pairs)
    assert all(r["match_doc_id"] == r["doc_id"] ^ 1 for r in got)


def test_repeats_within_a_document_do_not_count(spark):
    docs = [(1, " ".join([prose(3, 60)] * 40)), (2, " ".join([prose(4, 60)] * 3)), (3, "one two " * 5000)]
    assert op.repeated_passages(spark.createDataFrame(docs, KINDS)).count() == 0


def test_awkward(awkward, nothing):
    got = op.repeated_passages(awkward).collect()
    assert {(r["doc_id"], r["match_doc_id"]) for r in got} == {(6, 7), (7, 6)}
    assert op.repeated_passages(nothing).count() == 0


def test_edited_copies_in_a_crowd_meet_few_others(monkeypatch):
    """Copies of one text, edited at random places, reach as far as if all were compared, by few comparisons."""
    draw, n, width = np.random.default_rng(3), 1200, 2 * op.REACH + 1
    codes = np.repeat(draw.integers(1, 1 << 16, (1, width)), n, axis=0)
    edits = draw.random((n, width - op.WORDS)) < 0.012
    for row, at in zip(*np.nonzero(edits), strict=True):
        codes[row, at : at + op.WORDS] = draw.integers(1, 1 << 16, op.WORDS)
    codes[:, op.REACH : op.REACH + op.AHEAD + 1] = 1
    far, near = codes[:, : op.REACH][:, ::-1], codes[:, op.REACH + op.AHEAD + 1 :]
    ids, zeros, yes = np.arange(n), np.zeros(n, np.int64), np.ones(n, dtype=bool)
    sides = {"before": zeros + op.REACH, "after": zeros + op.REACH, "as_x": yes, "as_y": yes}
    places = {"one_id": ids, "one_place": zeros + 100, "two_id": ids, "two_place": zeros + 100}
    rows = pa.table({"bucket": zeros, "tile": zeros, "context": ids, "far": op._bytes(far), "near": op._bytes(near), **places, **sides})
    compared, verify = [], op.verify
    monkeypatch.setattr(op, "verify", lambda f, g, i, j: compared.append(len(i)) or verify(f, g, i, j))

    def reached():
        compared.clear()
        found = pa.Table.from_batches(op._compared(rows)).to_pydict()
        return sorted(zip(found["context"], found["to_left"], found["to_right"], strict=True)), sum(compared)

    got, pairs = reached()
    monkeypatch.setattr(op, "FEW", n)
    want, every = reached()
    assert got == want and len(got) > n // 2
    assert pairs < 40 * n < every


@pytest.mark.parametrize("few", [128, 2])
def test_a_passage_of_two_sources_is_in_the_class_of_both(spark, monkeypatch, few):
    """No link between different texts is lost: not to a second source, nor between two passages that both have exact copies."""
    monkeypatch.setattr(op, "FEW", few)

    def alone(i):
        return prose(50_000 + i, 40)

    one, other, edited = prose(40_000, 60), prose(40_001, 60), prose(40_002, 50).split()
    docs = [(1, f"{alone(1)} {one} {alone(2)}"), (2, f"{alone(3)} {other} {alone(4)}"), (3, f"{alone(5)} {one} {other} {alone(6)}")]
    # Two texts have the passage, and two others have it with another word in the middle.
    changed = [*edited[:25], "other", *edited[26:]]
    docs += [(10 + i, " ".join([alone(10 + i), *(edited if i < 2 else changed), alone(20 + i)])) for i in range(4)]
    docs += [(20 + i, f"{alone(30 + i)} {prose(40_003, 55)} {alone(40 + i)}") for i in range(2)]
    got = op.repeated_passages(spark.createDataFrame(docs, KINDS)).collect()
    classes = {}
    for r in got:
        classes.setdefault((r["class_doc_id"], r["class_first_word"]), set()).add(r["doc_id"])
    assert sorted(map(sorted, classes.values())) == [[1, 2, 3], [10, 11, 12, 13], [20, 21]]
    assert all(c[0] == min(ids) for c, ids in classes.items())


@pytest.mark.parametrize(("few", "parts"), [(4, 32_768), (4, 40)])
def test_classes_in_a_crowd_are_those_of_all_pairs(spark, monkeypatch, few, parts):
    """Chains of edited copies around a common middle: what is tied over any link is one class, in groups of any size and in parts of them."""
    draw, docs = random.Random(5), []
    middle = prose(60_000, 26).split()
    for family in range(12):
        passage = [*prose(61_000 + family, 34).split(), *middle, *prose(62_000 + family, 34).split()]
        for step in range(6):
            at = draw.choice([*range(0, 30, 3), *range(64, 94, 3)])
            passage = [*passage[:at], f"e{family}x{step}", *passage[at + 1 :]]
            docs.append((family * 10 + step, " ".join([prose(63_000 + family * 10 + step, 20), *passage, prose(64_000 + family * 10 + step, 20)])))
    table = spark.createDataFrame(docs, KINDS)

    def classes():
        return {(r["doc_id"], r["first_word"]): (r["class_doc_id"], r["class_first_word"]) for r in op.repeated_passages(table).collect()}

    want = classes()
    monkeypatch.setattr(op, "FEW", few)
    monkeypatch.setattr(op, "PART_CLASSES", parts)
    assert len(want) >= 60 and classes() == want
