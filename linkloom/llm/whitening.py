"""Whitening of embeddings by a bidiagonal qd solver.

Every task reduces its centred rows to a triangle by QR, block after block; the triangles of tasks are
reduced in the same way, a few dozen together, until one is left, which holds all of the covariance and
is as wide as a vector is long. Its right singular vectors and values (:mod:`linkloom.llm.bidiagonal`) are the components:
the covariance itself is never formed, so that small components keep their digits. Only sums, the last triangle
and the components pass the driver, whose sizes depend on the length of a vector alone.

Entries are made integers first, ``floor(64 * entry) + 1000000``, so that sums and deviations are exact.

Defined results: a vector that is null or holds a null or an entry that is not finite is left out. So is one of
another length than most have (of equally frequent lengths the longer one), as it lies in another space; empty vectors have no components. Entries
beyond 2**30 in size count as 2**30. A component whose spread is lost in rounding, as of a constant dimension or
of a single vector, is not returned. A ``deviation`` that no long can hold is null. Rows that repeat an id, null
ids and ties are rows like others. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.bidiagonal import EPS, right_singular
from linkloom.llm.common import ship_package, table, written

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 30)
# Numbers a task holds at once as a block of rows.
BLOCK_NUMBERS = 1 << 18
# Results of tasks that one task reduces to one.
FAN_IN = 32
_LOW_BITS = 20
_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``vec_id, v`` of the rows with finite entries and the length that most have, and that length."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(F.size("v") > 0)
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    most = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    length = 0 if most is None else int(most["length"])
    return rows.where(F.size("v") == length), length


def integers(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """The whole-number entries of a batch, a row per vector."""
    entries = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length)
    return np.floor(SCALE * np.clip(entries, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    rows = max(2 * length, BLOCK_NUMBERS // length)
    for batch in batches:
        for low in range(0, len(batch), rows):
            yield batch.slice(low, rows)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exactly: 64-bit numbers while they can hold it, Python's otherwise."""
    small = n * int(np.abs(x).max(initial=0)) < 1 << 61
    kind = np.int64 if small else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def one_per_task(rows: DataFrame, start: Callable, add: Callable, length: int) -> DataFrame:
    """``part, state`` of each task with rows: ``start()`` with every block added by ``add(state, x)``, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in blocks(batches, length):
            state = add(start() if state is None else state, integers(batch, length))
        if state is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "state": [state.tobytes()]})

    return rows.mapInArrow(run, "part bigint, state binary")


def reduced(states: DataFrame, merge: Callable, label: str) -> bytes:
    """All states merged into one, ``FAN_IN`` at a time; a task run again merges the same ones."""
    states = written(states, label)
    left = states.count()
    while left > 1:
        groups = states.withColumn("part", F.expr(f"part div {FAN_IN}"))

        def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            whole = None
            for state in group["state"]:
                whole = state if whole is None else merge(whole, state)
            return pd.DataFrame({"part": [key[0]], "state": [whole]})

        states = written(groups.groupBy("part").applyInPandas(one, "part bigint, state binary"), label)
        left = states.count()
    return bytes(states.first()["state"])


def sums_of(rows: DataFrame, length: int) -> tuple[int, list[int]]:
    """How many vectors there are, and their exact sum."""
    # The high and the low bits of entries are summed apart: neither sum outgrows 64 bits.
    def add(state: np.ndarray, x: np.ndarray) -> np.ndarray:
        state[0] += len(x)
        state[1 : length + 1] += (x >> _LOW_BITS).sum(axis=0)
        state[length + 1 :] += (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
        return state

    def merge(one: bytes, other: bytes) -> bytes:
        return (np.frombuffer(one, np.int64) + np.frombuffer(other, np.int64)).tobytes()

    states = one_per_task(rows, lambda: np.zeros(2 * length + 1, dtype=np.int64), add, length)
    total = np.frombuffer(reduced(states, merge, "vector-sums"), dtype=np.int64).tolist()
    return total[0], [(high << _LOW_BITS) + low for high, low in zip(total[1 : length + 1], total[length + 1 :], strict=True)]


def triangle_of(rows: DataFrame, length: int, n: int, sums: list[int]) -> np.ndarray:
    """The triangle of the QR factorisation of all centred rows."""

    def add(state: np.ndarray, x: np.ndarray) -> np.ndarray:
        return _triangle(np.vstack([state, centred(x, n, sums)]), length)

    def merge(one: bytes, other: bytes) -> bytes:
        both = [np.frombuffer(r, np.float64).reshape(length, length) for r in (one, other)]
        return _triangle(np.vstack(both), length).tobytes()

    states = one_per_task(rows, lambda: np.zeros((0, length)), add, length)
    return np.frombuffer(reduced(states, merge, "triangles"), np.float64).reshape(length, length)


def _triangle(rows: np.ndarray, length: int) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((length - len(r), length))]) if len(r) < length else r


def identity_error(rows: DataFrame, length: int, n: int, sums: list[int], directions: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    k = directions.shape[1]

    def add(state: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ directions
        return state + np.vstack([w.sum(axis=0), w.T @ w])

    def merge(one: bytes, other: bytes) -> bytes:
        return (np.frombuffer(one, np.float64) + np.frombuffer(other, np.float64)).tobytes()

    states = one_per_task(rows, lambda: np.zeros((k + 1, k)), add, length)
    total = np.frombuffer(reduced(states, merge, "whitened-sums"), np.float64).reshape(k + 1, k) / n
    # Rows are centred already; what rounding leaves of their mean is taken off.
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whitening(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows, length = usable(vectors, id_col, vector_col)
    if length == 0:
        return spark.createDataFrame([], _RESULT)
    n, sums = sums_of(rows, length)
    spread, v = right_singular(triangle_of(rows, length, n, sums))
    explained = spread**2 / max(float((spread**2).sum()), 1e-300)
    # What rounding makes of a component without spread: entries are near SHIFT, their products with n are exact.
    firm = int((spread > 16 * length * EPS * max(float(spread[0]), 1e-300)).sum()) if spread[0] > 0 else 0
    k = min(components, firm)
    if k == 0:
        return spark.createDataFrame([], _RESULT)
    directions = v[:, :k] * (n**0.5 / spread[:k])
    error = identity_error(rows, length, n, sums, directions)
    sent = spark.sparkContext.broadcast((n, sums, directions, explained[:k]))  # length x components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, directions, explained = sent.value
        for batch in blocks(batches, length):
            exact = deviations(integers(batch, length), n, sums)
            whitened = (exact / n).astype(np.float64) @ directions
            count = len(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(count), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, n, dtype=np.int64)),
                    _repeated(_squares(exact), k),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, _RESULT)


def _squares(exact: np.ndarray) -> list:
    """The sum of squares of each row; None beyond 64 bits."""
    if exact.dtype != object and len(exact) and float(np.abs(exact).max()) ** 2 * exact.shape[1] < 2.0**62:
        return (exact * exact).sum(axis=1).tolist()
    totals = [sum(int(x) ** 2 for x in row) for row in exact]
    return [t if t < 1 << 63 else None for t in totals]


def _repeated(values: list, k: int) -> pa.Array:
    return pa.array(values, pa.int64()).take(pa.array(np.repeat(np.arange(len(values)), k)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"))
