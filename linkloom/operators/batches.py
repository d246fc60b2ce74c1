"""Batches over sharded cells, in file order, merged over shards, or shuffled by chunk."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.cells import div
from linkloom.operators.lookup import lookup_join
from linkloom.operators.positions import with_positions
from linkloom.runtime import written

CHUNK_SIZE = 16 * 1024


def shard_sizes(cells: DataFrame) -> DataFrame:
    return cells.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))


def total_size(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count(F.lit(1)).alias("size"))


def num_batches(size: int, batch_size: int, allow_partial: bool = True) -> int:
    return math.ceil(size / batch_size) if allow_partial else size // batch_size


def with_batches(positioned: DataFrame, batch_size: int) -> DataFrame:
    """Add ``batch_id`` from the global position ``seq``."""
    return positioned.withColumn("batch_id", div(F.col("seq"), batch_size))


def drop_partial_batch(batched: DataFrame, batch_size: int, size: int) -> DataFrame:
    """Without the last batch if it is short; ``size`` is the number of cells."""
    return batched.where(F.col("batch_id") < num_batches(size, batch_size, allow_partial=False))


def place_in_shards(cells: DataFrame, order: Sequence[str] = ("row", "col")) -> DataFrame:
    """Add ``seq``, the position over all shards, and ``pos``, the one within the shard.

    ``cells`` is a stored table; cells may be repeated.
    """
    placed = with_positions(cells, "shard", *order, name="seq", copies=True)
    # One row per shard.
    starts = placed.groupBy("shard").agg(F.min("seq").alias("_start"))
    return placed.join(F.broadcast(starts), "shard").withColumn("pos", F.col("seq") - F.col("_start")).drop("_start")


def batch_sequential(cells: DataFrame, batch_size: int, order: Sequence[str] = ("row", "col")) -> DataFrame:
    """Shard after shard; a batch may span two."""
    return with_batches(place_in_shards(cells, order), batch_size)


def merge_shards(placed: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Chunk k holds records k*c to (k+1)*c of every shard; sets ``chunk`` and a new ``seq``.

    The new position follows from the shard sizes and the old one: cells are not
    sorted again. Shards that have run out drop out of later chunks.
    """
    sizes = written(shard_sizes(placed), "shard-sizes")
    # One number per shard.
    all_sizes = F.array(*(F.lit(r["size"]).cast("bigint") for r in sizes.collect()))
    start = F.col("chunk") * chunk_size
    numbers = F.sequence(F.lit(0), div(F.col("size") - 1, chunk_size))
    chunks = sizes.select("shard", "size", F.explode(numbers).alias("chunk"))
    records = F.least(F.lit(chunk_size).cast("bigint"), F.col("size") - start)
    earlier_chunks = F.aggregate(
        all_sizes, F.lit(0).cast("bigint"), lambda total, size: total + F.least(size, start)
    )
    earlier_shards = F.sum(records).over(Window.partitionBy("chunk").orderBy("shard")) - records
    offsets = written(
        chunks.select("chunk", "shard", (earlier_chunks + earlier_shards).alias("_offset")), "chunk-offsets"
    )
    placed = placed.withColumn("chunk", div(F.col("pos"), chunk_size))
    # At most chunk_size cells share a key.
    joined = lookup_join(placed, offsets, ["chunk", "shard"], spread_by=["seq"])
    return joined.withColumn("seq", F.col("_offset") + F.col("pos") % chunk_size).drop("_offset")


def batch_merged(
    cells: DataFrame, batch_size: int, chunk_size: int = CHUNK_SIZE, order: Sequence[str] = ("row", "col")
) -> DataFrame:
    """Batches over chunks merged from all shards."""
    return with_batches(merge_shards(place_in_shards(cells, order), chunk_size), batch_size)


def shuffle_key(seed: int, epoch: int) -> Column:
    text = F.concat_ws(":", F.lit(seed), F.lit(epoch), F.col("row"), F.col("col"), F.col("pos"))
    return F.md5(text.cast("binary"))


def shuffle_chunks(chunked: DataFrame, seed: int, epoch: int = 0, chunk: Sequence[str] = ("chunk",)) -> DataFrame:
    """Set ``seq`` to a random order within each chunk, another one in every epoch.

    ``chunk`` names the columns that make up a chunk, in order: ``("chunk",)`` after a
    merge, ``("shard", "chunk")`` for shard after shard. A range-partitioned sort, so
    that a chunk may be larger than a task.
    """
    keyed = chunked.drop("seq").withColumn("_key", shuffle_key(seed, epoch))
    return with_positions(keyed, *chunk, "_key", "shard", "pos", name="seq").drop("_key")
