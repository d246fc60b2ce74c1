"""Batches fetched from a stored order of cells, reading only the row groups that hold them.

A store is a folder of Parquet files in order of ``seq``, and a small index with a row for every row group: its
file, number and the positions it holds. Batches of any size are found in the index by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.cells import div
from linkloom.runtime import ship_package
from linkloom.sources.coo import open_path

# Bytes of a row group; what a fetch reads at least.
GROUP_BYTES = 1 << 20
_INDEX = "file string, row_group int, first bigint, last bigint"
_CELLS = "shard int, row bigint, col bigint, value float, seq bigint"


def write_batch_store(placed: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Store cells ``(shard, row, col, value, seq)`` by position, and the index of their row groups.

    The index is written last; a store without it is not complete and is refused.
    """
    spark = placed.sparkSession
    names = [f.split(" ")[0] for f in _CELLS.split(", ")]
    cells = placed.select(*(F.col(n).cast(k) for n, k in (f.split(" ") for f in _CELLS.split(", "))))
    ordered = cells.select(*names).repartitionByRange("seq").sortWithinPartitions("seq")
    # Row groups are cut when a page is full at the latest, so pages are kept smaller than groups.
    writer = ordered.write.option("parquet.block.size", group_bytes).option("parquet.page.size", max(1024, group_bytes // 8))
    writer.mode("errorifexists").parquet(f"{path}/cells")
    row_groups(spark, f"{path}/cells").write.parquet(f"{path}/index")


def row_groups(spark: SparkSession, cells: str) -> DataFrame:
    """``(file, row_group, first, last)`` of all row groups under a folder, read from the ends of the files."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(cells).select("path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for file in batch["path"]:
                system, base = open_path(file)
                with system.open_input_file(base) as source:
                    meta = pq.ParquetFile(source).metadata
                    seq = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "seq")
                    for g in range(meta.num_row_groups):
                        limits = meta.row_group(g).column(seq).statistics
                        found.append((file, g, limits.min, limits.max))
            yield pd.DataFrame(found, columns=["file", "row_group", "first", "last"])

    return files.mapInPandas(read, _INDEX)


def covering_groups(spark: SparkSession, path: str, wanted: DataFrame, batch_size: int) -> DataFrame:
    """``(file, row_group, batches)``: the row groups that hold any of the batches ``wanted (batch_id)``, and which.

    A row group has no more batches than rows; batches that do not exist have no row group.
    """
    index = spark.read.schema(_INDEX).parquet(f"{path}/index")
    numbers = F.sequence(div(F.col("first"), batch_size), div(F.col("last"), batch_size))
    held = index.select("file", "row_group", F.explode(numbers).alias("batch_id"))
    found = held.join(wanted.select(F.col("batch_id").cast("bigint")).distinct(), "batch_id")
    return found.groupBy("file", "row_group").agg(F.collect_list("batch_id").alias("batches"))


def fetch_batches(spark: SparkSession, path: str, wanted: DataFrame, batch_size: int) -> DataFrame:
    """``(shard, row, col, value, seq, batch_id)`` of the batches ``wanted (batch_id)``; nulls name no batch."""
    ship_package(spark)
    groups = covering_groups(spark, path, wanted, batch_size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.to_pylist():
                system, base = open_path(group["file"])
                with system.open_input_file(base) as source:
                    cells = pq.ParquetFile(source).read_row_group(group["row_group"])
                ids = pc.divide(cells["seq"], pa.scalar(batch_size, pa.int64()))
                chosen = cells.append_column("batch_id", ids)
                chosen = chosen.filter(pc.is_in(ids, pa.array(group["batches"], pa.int64())))
                yield from chosen.to_batches()

    return groups.mapInArrow(read, f"{_CELLS}, batch_id bigint")
