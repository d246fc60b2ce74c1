"""Dense 0-based positions in a stated total order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.text import natural_key
from linkloom.operators.lookup import lookup_join
from linkloom.runtime import written

# Fixed by Spark: monotonically_increasing_id is the partition number followed by
# 33 bits for the row within the partition.
_ROW_BITS = 33


def with_positions(df: DataFrame, *order, name: str = "id", copies: bool = False) -> DataFrame:
    """Number the rows 0..n-1 in ``order``.

    A range-partitioned sort is written once together with each row's partition and
    place in it; the position is that place plus the rows in earlier partitions.
    Rows equal in ``order`` would all be sorted by one task. Set ``copies`` if there may
    be many such; ``df`` must then be stored, so that a task run again sees its rows in
    the same sequence.
    """
    slot = F.monotonically_increasing_id()
    if copies:
        df, order = df.withColumn("_copy", slot), (*order, "_copy")
    placed = df.orderBy(*order).drop("_copy").withColumn("_slot", slot)
    placed = written(placed, "placed").withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    # One row per sort partition, so at most spark.sql.shuffle.partitions rows.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_start"))
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + place)
        .drop("_part", "_slot", "_start")
    )


def dense_ids(names: DataFrame, *order) -> DataFrame:
    """``(id, ...)`` with ids 0..n-1 in ``order``."""
    return with_positions(names, *order, name="id").select("id", *names.columns)


def file_order() -> list[Column]:
    """Order of lines over files: by name with numbers compared as such, then by place in the file.

    The only order of lines in this library; ``part-99999`` comes before ``part-100000``.
    """
    return [natural_key(F.col("file")), F.col("file"), F.col("block")]


def in_file_order(lines: DataFrame, *before, after: Sequence = ()) -> DataFrame:
    """``lines`` sorted by ``before``, their place in the files and ``after``.

    The sortable form of the file name is made once per line; as a sort key it would be made again for every comparison.
    """
    keyed = lines.withColumn("_file_key", natural_key(F.col("file")))
    return keyed.orderBy(*before, "_file_key", "file", "block", "slot", *after).drop("_file_key")


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_no``, the 0-based line number over all files in name order.

    ``lines`` comes from :func:`linkloom.sources.lines.read_lines`. Lines are counted
    per file split; only that count, one row per split, is ordered and summed up.
    """
    splits = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("slot").alias("_first")
    )
    in_order = Window.orderBy(*file_order())
    starts = written(
        splits.select(
            "file", "block", (F.sum("_rows").over(in_order) - F.col("_rows") - F.col("_first")).alias("_shift")
        ),
        "line-starts",
    )
    return (
        lookup_join(lines, starts, ["file", "block"], spread_by=["slot"])
        .withColumn("line_no", F.col("slot") + F.col("_shift"))
        .drop("_shift")
    )
