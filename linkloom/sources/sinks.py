"""Writers. Ordered outputs are folders of part files whose names follow the order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.cells import hash_shard
from linkloom.operators.positions import in_file_order
from linkloom.operators.ranking import rank_desc, rank_line, rank_order, with_count_shard
from linkloom.sources.chunks import write_chunks


def write_lines(lines: DataFrame, path: str, *order, mode: str = "errorifexists") -> None:
    """Write ``value`` in a global order, from a range-partitioned sort."""
    write_ordered(lines.orderBy(*order), path, mode)


def write_ordered(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``value`` of sorted lines."""
    lines.select("value").write.mode(mode).option("lineSep", "\n").text(path)


def write_ranked(counts: DataFrame, path: str) -> None:
    """The ranking as ``title<TAB>count`` lines."""
    rank_desc(counts).select(rank_line().alias("value")).write.text(path)


def write_shard_counts(counts: DataFrame, path: str, shards: int) -> None:
    """One descending ``title<TAB>count`` file per shard, in folders ``shard=<name>``."""
    (
        with_count_shard(counts, shards)
        .repartitionById(shards, hash_shard(F.col("page_title"), shards).cast("int"))
        .sortWithinPartitions("shard", *rank_order())
        .select("shard", rank_line().alias("value"))
        .write.partitionBy("shard")
        .text(path)
    )


def _in_line_order(df: DataFrame, *after: str) -> DataFrame:
    return df.orderBy("line_no", *after) if "line_no" in df.columns else in_file_order(df, after=after)


def write_dump(rebuilt: DataFrame, path: str) -> None:
    """Rebuilt dump lines in input order."""
    write_ordered(_in_line_order(rebuilt), path)


def write_dump_chunks(rebuilt: DataFrame, path: str) -> None:
    """The same, one folder ``chunk=<k>`` per chunk. Needs ``line_no`` and ``chunk``."""
    write_chunks(rebuilt, path, "chunk", "line_no")


def write_ids(ids: DataFrame, path: str) -> None:
    """Ids of surviving tuples, one per line, in input order."""
    write_ordered(_in_line_order(ids.withColumn("value", F.col("id").cast("string")), "pos"), path)


def write_id_chunks(ids: DataFrame, path: str) -> None:
    """The same, one folder ``chunk=<k>`` per chunk. Needs ``line_no`` and ``chunk``."""
    write_chunks(ids.withColumn("value", F.col("id").cast("string")), path, "chunk", "line_no", "pos")


def write_names(names: DataFrame, path: str, *order) -> None:
    """Names of a dictionary, one per line; the line number is the id."""
    write_lines(names.withColumnRenamed("name", "value"), path, *order)


def write_cells(cells: DataFrame, path: str) -> None:
    """Cells as Parquet, one folder ``shard=<i>`` per shard, sorted by row and column.

    Cut into ranges of about equal size: a large shard is written by several tasks, and
    no task writes to more than its few neighbouring shards.
    """
    ordered = cells.repartitionByRange("shard", "row", "col").sortWithinPartitions("shard", "row", "col")
    ordered.write.partitionBy("shard").parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Exported vectors in dictionary order."""
    write_lines(vectors, path, "id")
