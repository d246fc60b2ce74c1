import math

import numpy as np
import pytest

from linkloom.llm import whitening as w
from linkloom.llm.bidiagonal import right_singular
from linkloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def brute(vectors: list[tuple[int, list[float]]], components: int):
    """Exact sums with Python's integers, eigenvectors of the covariance with numpy's own solver."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    rows = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, basis = np.linalg.eigh(rows.T @ rows / n)
    order = np.argsort(-values)[:components]
    return n, deviation, rows @ basis[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def by_row(result):
    return sorted(result.collect(), key=lambda r: (r.vec_id, r.component))


def test_query_equals_other_solver(spark):
    found = by_row(QUERIES["op13_whitening"](spark, DATA))
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()]
    n, deviation, white, share = brute(vectors, 32)
    assert len(found) == 32 * len(vectors) and {r.n for r in found} == {n}
    mine = np.array([r.whitened for r in found]).reshape(n, 32)
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-8
    assert [r.deviation for r in found[::32]] == deviation
    assert np.allclose([r.explained for r in found[:32]], share, rtol=1e-10)
    assert max(r.identity_error for r in found) < 1e-10 and len({r.identity_error for r in found}) == 1
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(32)).max() < 1e-10


def test_result_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 2)
    monkeypatch.setattr(w, "BLOCK_NUMBERS", 64)
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    one, many = by_row(w.whitening(table.coalesce(1), 3)), by_row(w.whitening(table.repartition(7), 3))
    a, b = (np.array([r.whitened for r in rows]).reshape(-1, 3) for rows in (one, many))
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-9) and [r.deviation for r in one] == [r.deviation for r in many]


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 5.0], "a"), (2, [2.0, 1.0, 5.0], "b"), (2, [2.0, 1.0, 5.0], "b"), (None, [0.5, -3.0, 5.0], None),
        (4, None, "c"), (5, [1.0, None, 2.0], "c"), (6, [1.0, nan, 2.0], "c"), (7, [inf, 0.0, 2.0], "c"), (8, [], "c"), (9, [1.0], "c"),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, `meta.v` string")
    for name in ("n", "v", "part", "state", "component"):
        table = table.withColumn(name, table["`meta.v`"])
    found = w.whitening(table).collect()
    # The third dimension is constant, so two components are left of four vectors.
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    kept = [(0, v) for i, v, _ in rows[:4]]
    _, deviation, white, _ = brute(kept, 2)
    assert sorted({r.deviation for r in found}) == sorted(set(deviation))
    assert np.allclose(sorted(abs(r.whitened) for r in found), sorted(np.abs(white).ravel()), atol=1e-8)


def test_nothing_and_no_spread(spark):
    kinds = "vec_id bigint, embedding array<float>"
    same = [(i, [1.0, 2.0]) for i in range(5)]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], same):
        result = w.whitening(spark.createDataFrame(rows, kinds))
        assert result.collect() == [] and result.schema.simpleString() == spark.createDataFrame([], w._RESULT).schema.simpleString()


def test_huge_entries_stay_exact(spark):
    rows = [(i, [1e37 if i == 3 else float(i), -(2.0**29) * i]) for i in range(6)]
    clipped = [(i, [min(a, 2.0**30), max(b, -(2.0**30))]) for i, (a, b) in rows]
    _, deviation, _, _ = brute(clipped, 2)
    found = by_row(w.whitening(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")))
    assert [r.deviation for r in found[::2]] == [d if d < 1 << 63 else None for d in deviation]


@pytest.mark.parametrize("kind", ["random", "graded", "ties", "rank", "zero", "one"])
def test_solver(kind):
    draw = np.random.default_rng(3)
    full = draw.normal(size=(40, 24))
    made = {
        "random": full,
        "graded": full * 10.0 ** -np.arange(24),
        "ties": np.diag([4.0] * 8 + [2.0] * 8 + [1.0] * 8) @ np.linalg.qr(draw.normal(size=(24, 24)))[0],
        "rank": draw.normal(size=(40, 3)) @ draw.normal(size=(3, 24)),
        "zero": np.zeros((24, 24)),
        "one": np.array([[2.0]]),
    }[kind]
    r = np.linalg.qr(made, mode="r")
    sizes, v = right_singular(r)
    assert np.allclose(sizes, np.linalg.svd(r, compute_uv=False), rtol=0, atol=1e-13 * max(1.0, sizes[0]))
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-13
    assert np.abs(r.T @ r @ v - v * sizes**2).max() <= 1e-13 * max(1.0, sizes[0] ** 2)
