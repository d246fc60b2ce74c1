"""Ids of names by a dictionary in few bytes, for dictionaries that are too large to broadcast as a table.

The names are sorted in ranges, numbered, and each run of 65,536 is encoded by one task (see
:mod:`linkloom.functions.front_coding`). What comes out is measured; up to ``COMPACT_BYTES`` it is sent to all Python workers, and
the facts are looked up where they are, in Arrow batches, without a shuffle. Beyond that they are joined by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from linkloom.functions.front_coding import PART_NAMES, Dictionary, Part, encode_part
from linkloom.operators.lookup import BROADCAST_BYTES, lookup_join, stored_bytes
from linkloom.operators.positions import with_positions
from linkloom.runtime import ship_package, written

# A dictionary is sent to the workers, each of which holds a copy, up to this measured size.
COMPACT_BYTES = 256 << 20
# Encoding is tried up to so many times that size of plain names and ids.
HOPED_RATIO = 4
# Names looked up at once.
_ROWS = 1 << 16

_PARTS = "part bigint, n bigint, " + ", ".join(f"{f} binary" for f in Part._fields[1:])
# The dictionary a worker has put together last.
_loaded: dict[str, Dictionary] = {}


class Compact(NamedTuple):
    """Encoded parts, stored one row each, of ``names`` names in ``size`` bytes."""

    parts: DataFrame
    names: int
    size: int

    @property
    def bytes_per_name(self) -> float:
        return self.size / max(1, self.names)


def compact_dictionary(ids: DataFrame) -> Compact:
    """``ids(name, id)``, one row per name with ids from 0 on, encoded; a missing name is left out."""
    ship_package(ids.sparkSession)
    placed = with_positions(ids.where("name is not null").select("name", F.col("id").cast("bigint").alias("id")), "name", name="_place")
    part = F.floor(F.col("_place") / PART_NAMES).cast("bigint").alias("part")
    rows = placed.select(part, F.col("name").cast("binary").alias("name"), F.xxhash64(F.col("name").cast("binary")).alias("hash"), "id")
    parts = written(rows.groupBy("part").applyInArrow(_encode, _PARTS), "compact-parts")
    width = sum((F.octet_length(f) for f in Part._fields[1:]), F.lit(0))
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return Compact(parts, total["n"], total["size"])


def _encode(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("name")
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    part = encode_part(rows.column("name").to_pylist(), hashes, rows.column("id").to_numpy())
    values = {"part": key[0].as_py(), **part._asdict()}
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * (len(Part._fields) - 1)]
    return pa.table({name: pa.array([value], kind) for (name, value), kind in zip(values.items(), kinds, strict=True)})


def _parts(rows: list[dict]) -> list[Part]:
    return [Part(*(r[f] for f in Part._fields)) for r in sorted(rows, key=lambda r: r["part"])]


def decoded(compact: Compact) -> DataFrame:
    """``(id, name)`` of all names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Dictionary(_parts([row]))
                ids = pa.array(one.ids.astype(np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.array(one.names(0), pa.binary())], ["id", "name"])

    return compact.parts.mapInArrow(run, "id bigint, name binary").select("id", F.col("name").cast("string").alias("name"))


def find_ids(facts: DataFrame, compact: Compact, name_col: str) -> DataFrame:
    """``facts`` with ``id``: that of its name, -1 if it is unknown or missing. Nothing is shuffled.

    The parts go through the driver: check ``compact.size`` before.
    """
    spark = facts.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(_parts(compact.parts.toArrow().to_pylist()))
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _loaded:
            _loaded.clear()
            _loaded[token] = Dictionary(sent.value)
        for whole in batches:
            for low in range(0, len(whole), _ROWS):
                batch = whole.slice(low, _ROWS)
                names, hashes = batch.column("_name"), batch.column("_hash").to_numpy(zero_copy_only=False)
                ids = _loaded[token].find(names.fill_null(b"").to_pylist(), hashes.view(np.uint64))
                ids[names.is_null().to_numpy(zero_copy_only=False)] = -1
                kept = [batch.column(i) for i in range(len(batch.schema) - 2)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids)], [*batch.schema.names[:-2], "id"])

    # Texts pass as bytes, as they need not be valid UTF-8.
    texts = [f.name for f in facts.schema.fields if isinstance(f.dataType, StringType)]
    name = F.col(name_col).cast("binary")
    rows = facts.select(
        *(F.col(c).cast("binary").alias(c) if c in texts else F.col(c) for c in facts.columns), name.alias("_name"), F.xxhash64(name).alias("_hash")
    )
    schema = StructType([*rows.schema.fields[:-2]]).add("id", LongType())
    found = rows.mapInArrow(run, schema)
    return found.select(*(F.col(c).cast("string").alias(c) if c in texts else F.col(c) for c in facts.columns), "id")


def with_ids(
    facts: DataFrame, ids: DataFrame, name_col: str, spread_by: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES,
    compact_bytes: int = COMPACT_BYTES,
) -> DataFrame:
    """``facts`` with ``id`` from the stored ``ids(name, id)``, -1 if the name is unknown.

    By a broadcast table, a broadcast compact dictionary or a join by key, whichever the measured sizes allow first.
    """
    plain = stored_bytes(ids)
    if broadcast_bytes < plain <= HOPED_RATIO * max(compact_bytes, broadcast_bytes):
        compact = compact_dictionary(ids)
        if compact.size <= compact_bytes:
            return find_ids(facts, compact, name_col)
    names = ids.select(F.col("name").alias(name_col), "id")
    found = lookup_join(facts, names, [name_col], "left", spread_by=spread_by, broadcast_bytes=broadcast_bytes)
    return found.select(*facts.columns, F.coalesce("id", F.lit(-1).cast("bigint")).alias("id"))
