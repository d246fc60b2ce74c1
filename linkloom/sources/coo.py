"""Binary shard files of the link matrix: 12-byte records (row uint32, col uint32, value float32)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources.cell_shards import FORMAT, RECORD, SLICE_RECORDS, open_path, qualified, register

__all__ = ["RECORD", "open_path", "read_coo", "write_coo"]


def read_coo(spark: SparkSession, folder: str, slice_records: int = SLICE_RECORDS) -> DataFrame:
    """``(shard, pos, row, col, value)``; ``pos`` is the record number within the shard file.

    Only the file lengths are listed up front; files are then read in slices, in any
    number of tasks. A rest shorter than a record is ignored. A folder with shards of several sets is refused.
    """
    register(spark)
    return spark.read.format(FORMAT).option("slice_records", str(slice_records)).load(qualified(spark, folder))


def write_coo(cells: DataFrame, folder: str, shards: int, overwrite: bool = False) -> None:
    """Shard files for a trainer that reads the binary form; ``cells`` has ``shard`` 0..shards-1.

    The format wants one file per shard, so each is written by one task, in batches
    and in the order of row and column. The set appears when all of it is written; shards without cells are empty files.
    A folder that holds shards is refused, or its whole set replaced with ``overwrite``.
    """
    spark = cells.sparkSession
    register(spark)
    named = cells.select(F.col("shard").cast("int").alias("shard"), "row", "col", "value")
    ordered = named.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "row", "col")
    mode = "overwrite" if overwrite else "append"
    ordered.write.format(FORMAT).option("shards", str(shards)).mode(mode).save(qualified(spark, folder))
