"""Shard, block and column arithmetic of the link matrix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(value: Column, divisor: int) -> Column:
    """Integer division, exact for all 64-bit values."""
    return F.call_function("div", value, F.lit(divisor))


def hash_shard(key: Column, shards: int) -> Column:
    """Shard of a key, by the CRC-32 of its text."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(shards)


def count_shard_name(shard: Column, shards: int) -> Column:
    return F.format_string("pagecounts-%03d-of-%03d", shard, F.lit(shards))


def cell_shard_name(shard: Column, shards: int) -> Column:
    return F.format_string("data.bin.%05d-of-%05d", shard, F.lit(shards))


def block_size(rows: int, blocks: int) -> int:
    return (rows - 1) // blocks + 1


def row_block(row: Column, rows: int, blocks: int) -> Column:
    """Contiguous row blocks of equal size; the last one may be shorter."""
    return div(row, block_size(rows, blocks))


def inlink_col(page_id: Column) -> Column:
    return page_id


def outlink_col(page_id: Column, pages: int) -> Column:
    return page_id + F.lit(pages)


def category_col(category_id: Column, pages: int) -> Column:
    return category_id + F.lit(2 * pages)


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )
