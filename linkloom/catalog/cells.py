"""Queries on matrix cells, zero cells and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.catalog.inputs import Inputs
from linkloom.catalog.oracle import query, zeros
from linkloom.catalog.registry import register
from linkloom.functions.cells import div, row_block
from linkloom.operators import batch_index, batches, zeros as op
from linkloom.runtime import new_path, written
from linkloom.sources.coo import read_coo, write_coo

BLOCKS = 4
FACTOR = 0.5
BATCH = 64
CHUNK = 100
SEED = 7

_SHARDED = f"""(select row // ((p - 1) // {BLOCKS} + 1) as shard, row, col, value from positives, shape)"""
# Position within the shard and over all shards.
_PLACED = f"""(select *, row_number() over (order by shard, row, col) - 1 as seq,
  row_number() over (partition by shard order by row, col) - 1 as pos from {_SHARDED})"""
_MERGED = f"""(select shard, row, col, pos, chunk, row_number() over (order by chunk, shard, pos) - 1 as seq
  from (select *, pos // {CHUNK} as chunk from {_PLACED}))"""
_SHUFFLED = f"""(select shard, row, col, chunk, row_number() over (order by chunk, digest, shard, pos) - 1 as seq
  from (select *, md5(concat_ws(':', '{SEED}', '0', row::VARCHAR, col::VARCHAR, pos::VARCHAR)) as digest from {_MERGED}))"""


def _sharded(t: Inputs) -> DataFrame:
    shape = t.dictionaries.shape()
    return t.positives.withColumn("shard", row_block(F.col("row"), shape.rows, BLOCKS))


@register("dedupe_cells", query("select row, col, value from positives", "positives"))
def dedupe_cells(t: Inputs) -> DataFrame:
    return op.dedupe_cells(t.cells)


@register("block_filter", query("select row, col from cells where row >= 10 and row < (select p // 2 from shape)", "cells"))
def block_filter(t: Inputs) -> DataFrame:
    return op.block_filter(t.cells, 10, t.dictionaries.shape().rows // 2).select("row", "col")


@register(
    "row_density",
    query("select (select count(*) from cells)::DOUBLE / p as density from shape", "cells"),
)
def row_density(t: Inputs) -> DataFrame:
    return op.row_density(t.cells, t.dictionaries.shape().rows)


_ZEROS = zeros(BLOCKS, FACTOR, op.SEED)


@register("inject_zeros", query(_ZEROS, "cells", "positives"))
def inject_zeros(t: Inputs) -> DataFrame:
    return op.inject_zeros(t.positives, t.dictionaries.shape(), BLOCKS, t.cells.count(), FACTOR)


@register(
    "union_zeros",
    query(
        f"""select row, col, value from positives
            union all select row, col, 0.0::FLOAT from ({_ZEROS})""",
        "cells",
        "positives",
    ),
)
def union_zeros(t: Inputs) -> DataFrame:
    drawn = op.inject_zeros(t.positives, t.dictionaries.shape(), BLOCKS, t.cells.count(), FACTOR)
    return op.union_zeros(t.positives, drawn)


@register(
    "anti_positive_cells",
    query(
        """select col as row, row as col from cells
           where col < (select p from shape) and (col, row) not in (select (row, col) from positives)""",
        "positives",
    ),
)
def anti_positive_cells(t: Inputs) -> DataFrame:
    """Links the other way round which do not exist."""
    inlinks = t.cells.where(F.col("col") < t.dictionaries.shape().rows)
    return op.anti_positive_cells(inlinks.select(F.col("col").alias("row"), F.col("row").alias("col")), t.positives)


@register("shard_sizes", query(f"select shard, count(*) as size from {_SHARDED} group by shard", "positives"))
def shard_sizes(t: Inputs) -> DataFrame:
    return batches.shard_sizes(_sharded(t))


@register("total_size", query("select count(*) as size from cells", "cells"))
def total_size(t: Inputs) -> DataFrame:
    return batches.total_size(t.cells)


@register(
    "num_batches",
    query(
        f"""select count(*) as size, (count(*) + {BATCH - 1}) // {BATCH} as batches, count(*) // {BATCH} as full_batches
            from positives""",
        "positives",
    ),
)
def num_batches(t: Inputs) -> DataFrame:
    size = t.positives.count()
    counts = (batches.num_batches(size, BATCH), batches.num_batches(size, BATCH, allow_partial=False))
    return t.spark.createDataFrame([(size, *counts)], "size bigint, batches bigint, full_batches bigint")


@register(
    "read_coo",
    query(f"select shard::INTEGER as shard, pos, row, col, value from {_PLACED}", "positives"),
)
def read_coo_query(t: Inputs) -> DataFrame:
    folder = new_path(t.spark, "coo")
    write_coo(_sharded(t), folder, BLOCKS)
    return read_coo(t.spark, folder, slice_records=1000)


@register(
    "batch_sequential",
    query(f"select shard, row, col, seq, seq // {BATCH} as batch_id from {_PLACED}", "positives"),
)
def batch_sequential(t: Inputs) -> DataFrame:
    return batches.batch_sequential(_sharded(t), BATCH).select("shard", "row", "col", "seq", "batch_id")


@register(
    "batch_merged",
    query(f"select shard, row, col, chunk, seq, seq // {BATCH} as batch_id from {_MERGED}", "positives"),
)
def batch_merged(t: Inputs) -> DataFrame:
    return batches.batch_merged(_sharded(t), BATCH, CHUNK).select("shard", "row", "col", "chunk", "seq", "batch_id")


@register("shuffle_chunks", query(f"select shard, row, col, chunk, seq from {_SHUFFLED}", "positives"))
def shuffle_chunks(t: Inputs) -> DataFrame:
    merged = batches.merge_shards(batches.place_in_shards(_sharded(t)), CHUNK)
    return batches.shuffle_chunks(merged, SEED).select("shard", "row", "col", "chunk", "seq")


@register(
    "drop_partial_batch",
    query(
        f"""select row, col, seq // {BATCH} as batch_id from {_PLACED}
            where seq // {BATCH} < (select count(*) from positives) // {BATCH}""",
        "positives",
    ),
)
def drop_partial_batch(t: Inputs) -> DataFrame:
    batched = batches.batch_sequential(_sharded(t), BATCH)
    return batches.drop_partial_batch(batched, BATCH, t.positives.count()).select("row", "col", "batch_id")


def _store(t: Inputs) -> str:
    path = new_path(t.spark, "batch-store")
    # Small row groups, so that a batch is a small part of even a small table.
    batch_index.write_batch_store(batches.place_in_shards(_sharded(t)), path, group_bytes=1 << 14)
    return path


_STARTS = f"(select min(seq) // {BATCH} as batch_id from {_PLACED} group by shard)"


@register(
    "fetch_batches",
    query(
        f"""select shard, row, col, value, seq, seq // {BATCH} as batch_id from {_PLACED}
            where seq // {BATCH} in (select batch_id from {_STARTS})""",
        "positives",
    ),
)
def fetch_batches(t: Inputs) -> DataFrame:
    """The batches in which a shard begins, by the index of row groups."""
    sizes = batches.shard_sizes(_sharded(t))
    before = F.sum("size").over(Window.orderBy("shard")) - F.col("size")  # one row per shard
    wanted = sizes.select(div(before, BATCH).alias("batch_id"))
    fetched = batch_index.fetch_batches(t.spark, _store(t), wanted, BATCH)
    return fetched.withColumn("shard", F.col("shard").cast("bigint"))


@register(
    "row_group_index",
    query("select count(*) as cells, 0::BIGINT as first, count(*) - 1 as last, true as unbroken, true as several from positives", "positives"),
)
def row_group_index(t: Inputs) -> DataFrame:
    """Whether the groups of the index follow one another without gap or overlap."""
    groups = written(batch_index.row_groups(t.spark, f"{_store(t)}/cells"), "row-groups")
    # One row per row group; each is held against the one that begins where it ends.
    after = groups.select((F.col("first") - 1).alias("last"), F.lit(1).alias("next"))
    follow = groups.join(after, "last", "left")
    size = F.sum(F.col("last") - F.col("first") + 1)
    return follow.agg(
        size.alias("cells"), F.min("first").alias("first"), F.max("last").alias("last"),
        (F.count(F.lit(1)) == F.count("next") + 1).alias("unbroken"), (F.count(F.lit(1)) > 1).alias("several"),
    )
