"""Exact and near dedup against plain Python, and what they make of awkward rows."""

import random

import numpy as np
import pytest
from brute import exact_groups, near_components, shingle_set
from compare import checker, compare
from conftest import DATA, prose

from linkloom.llm import exact_dedup, near_dedup
from linkloom.llm.common import written
from linkloom.llm.components import components
from linkloom.llm.queries import ORACLES, QUERIES


def test_exact_query_against_sql(spark):
    name = "op4_exact_dedup"
    count, _, plan = compare(spark, name, QUERIES[name], ORACLES[name], DATA, checker(DATA))
    assert count == 200 and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("support", [0.001, 0.2, 0.6])
def test_exact_with_and_without_heavy_hitters(spark, support):
    data = [(i, ["a", "A", "b", "É", "é"][i % 5] if i % 3 else "a") for i in range(90)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(docs, support=support).collect()}
    assert got == exact_groups([{"doc_id": i, "text": t} for i, t in data])


def test_exact_awkward(awkward, nothing):
    got = exact_dedup.exact_dedup(awkward).collect()
    assert len(got) == awkward.count() and exact_dedup.exact_dedup(nothing).count() == 0
    kept = sorted((r["doc_id"] for r in got if r["kept"]), key=str)
    # Of the empty texts 2 stays, of the two rows with id 5 one, of the equal texts with and without id the one with id.
    assert kept == sorted([2, 3, 5, 6, 7, 8, 8, 9, 10], key=str)
    assert {r["group_size"] for r in got if r["doc_id"] == 5} == {3}


def test_exact_stage(spark, awkward, nothing):
    got = exact_dedup.exact_dedup_stage(spark, awkward, DATA)
    assert got.columns == awkward.columns and got.schema == awkward.schema
    # Rows without id are left alone.
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([2, 3, 5, 6, 7, 8, 8, 9, 10, None, None], key=str)
    assert exact_dedup.exact_dedup_stage(spark, nothing, DATA).count() == 0


def _noisy(base: list[str], rate: float, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice("pqrst") + str(draw.random()) if draw.random() < rate else w for w in base)


@pytest.mark.parametrize("n", [2, 5])
def test_near_query_against_all_pairs(spark, rows, n):
    """Real documents and a group of copies that differ so much that only some pairs are links."""
    base = prose(5, 150).split()
    made = [{"doc_id": 10_000 + i, "text": _noisy(base, 0.002 * i, i)} for i in range(60)]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows + made], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(docs, n).collect()}
    want = near_components(rows + made, n)
    assert got == want
    assert 5 < len({c for i, (_, c) in want.items() if i >= 10_000}) < 60


def test_near_rest_is_found_where_centres_miss_it(spark):
    """Two tight pairs that resemble a common centre less than 0.8 stay two pairs, and are both found."""
    base = prose(8, 200).split()
    texts = {1: " ".join(base)}
    for k, start in ((2, 0), (4, 100)):
        copy = base[:]
        copy[start : start + 60] = prose(k, 60).split()
        texts[k], texts[k + 1] = " ".join(copy), " ".join(copy + ["more"])
    docs = [{"doc_id": i, "text": t} for i, t in texts.items()]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), 2).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 4} == {i: c for i, (_, c) in near_components(docs, 2).items()}


@pytest.mark.parametrize("nodes, size", [(512, 16 << 20), (20, 16 << 20), (512, 20_000)])
def test_near_group_in_blocks(spark, monkeypatch, nodes, size):
    """Copies of similarity 0.6 to 0.9: the same components for any size of blocks, and few links out of them."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", nodes)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", size)
    made, base = [], prose(7, 120).split()
    monkeypatch.setattr(near_dedup, "written", lambda df, label: made.append((label, out := written(df, label))) or out)
    docs = [{"doc_id": i, "text": _noisy(base, 0.02 + 0.05 * (i % 40) / 40, i)} for i in range(400)]
    docs += [{"doc_id": 1000 + i, "text": " ".join(base[: 118 - i % 3])} for i in range(60)]
    got = near_dedup.near_dedup(spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id bigint, text string"), 2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_components(docs, 2)
    links = dict(made)["remaining-links"]
    open_nodes = dict(made)["open-nodes"]
    assert links.count() < 4 * open_nodes.count()


def test_components_of_a_hub(spark, monkeypatch):
    from linkloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common.attach, "__defaults__", ("inner", None, 50, 0, None))
    edges = [(5, i) for i in range(6, 600)] + [(i, 5000 + i) for i in range(6, 300)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {v: 5 for e in edges for v in e}


def test_min_max_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 1 << 63, 6000, dtype=np.uint64) * np.uint64(2)
    one, other = np.unique(pool[:5000]), np.unique(pool[1000:])
    same = (near_dedup.min_max_signature(one) == near_dedup.min_max_signature(other)).mean()
    assert abs(same - 4000 / 6000) < 0.12


def test_near_awkward(awkward, nothing):
    got = near_dedup.near_dedup(awkward, 5).collect()
    assert len(got) == awkward.count() and near_dedup.near_dedup(nothing).count() == 0
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert [by_id[i]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7, 9)] == [1, 2, 3, 4, 4, 6, 6, 9]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)


def test_near_stage(spark, awkward, nothing):
    got = near_dedup.near_dedup_stage(spark, awkward, DATA)
    assert got.columns == awkward.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([1, 2, 3, 4, 6, 8, 8, 9, 10, None, None], key=str)
    assert near_dedup.near_dedup_stage(spark, nothing, DATA).count() == 0


def test_shingle_counts_of_short_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a b"), (3, "A  b c"), (4, "a")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(docs, 2).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (2, 3), 4: (1, 1)}
    assert len(shingle_set("A  b c", 2)) == 2


def test_components_of_chains_and_stars(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 250), (7, 7)]
    edges += [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(120)]
    parent = {v: v for e in edges for v in e}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
