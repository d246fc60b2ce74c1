"""Text sources. Every reader keeps the bytes of a line and its place in the input."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import chomp, parse_int, strip
from linkloom.operators.positions import number_lines
from linkloom.runtime import ship_package

# Fixed value: names of hourly view logs.
PAGEVIEW_FILE = r"pageviews-\d+-\d+\.gz"


def read_lines(
    spark: SparkSession, path: str | list[str], name_pattern: str | None = None, skip_corrupt: bool = False
) -> DataFrame:
    """``(value, file, block, slot)``: lines with their place.

    ``(file, block, slot)`` sorts in file order: a file is read in splits (``block``),
    and within a split ``slot`` grows from line to line. Only a line feed ends a line.
    """
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", str(skip_corrupt).lower())
    raw = reader.text(path)
    lines = raw.select(
        chomp(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("slot"),
        F.col("_metadata.file_name").alias("_name"),
    )
    if name_pattern is not None:
        lines = lines.where(F.col("_name").rlike(name_pattern))
    return lines.drop("_name")


def scan_pageviews(spark: SparkSession, folder: str, skip_corrupt: bool = False) -> DataFrame:
    """Lines of the hourly logs in a folder; other files are left out.

    A file that cannot be read fails the job. With ``skip_corrupt`` a file with a bad
    header gives no lines, and one that breaks off gives the lines before the break;
    :func:`skipped_files` names such files.
    """
    return read_lines(spark, folder, PAGEVIEW_FILE, skip_corrupt)


def skipped_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, reason)`` of the hourly logs that are not whole gzip files.

    Each file is unpacked once more, a piece at a time, by the task that reads it.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(path, reason) for path, content in zip(batch["path"], batch["content"]) if (reason := gzip_fault(content))]
            yield pd.DataFrame(found, columns=["file", "reason"])

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "pageviews-*.gz").load(folder)
    files = files.where(F.col("path").rlike(PAGEVIEW_FILE)).select("path", "content")
    return files.mapInPandas(check, "file string, reason string")


def gzip_fault(content: bytes, piece: int = 1 << 20) -> str | None:
    """What is wrong with a gzip file, if anything. It may hold several members, and zero bytes after the last."""
    whole, at = memoryview(content), 0
    try:
        while at < len(whole):
            unpack = zlib.decompressobj(wbits=31)
            while at < len(whole) and not unpack.eof:
                unpack.decompress(whole[at : at + piece])
                at += min(piece, len(whole) - at) - len(unpack.unused_data)
            if not unpack.eof:
                return "breaks off"
            while at < len(whole) and not whole[at]:
                # Padding, a piece at a time as far as it is all zeros.
                filled = bytes(whole[at : at + piece])
                at += len(filled) - len(filled.lstrip(b"\0"))
    except zlib.error as error:
        return f"not gzip data: {error}"
    return None


def scan_dump(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of a dump."""
    return number_lines(read_lines(spark, path))


def read_ranked_titles(spark: SparkSession, path: str) -> DataFrame:
    """Titles of a ``title<TAB>count`` file; lines with another number of fields are skipped."""
    without_tabs = F.replace(F.col("value"), F.lit("\t"), F.lit(""))
    one_tab = F.octet_length("value") - F.octet_length(without_tabs) == 1
    return (
        read_lines(spark, path)
        .where(one_tab)
        .select(F.substring_index("value", "\t", 1).alias("page_title"))
        .distinct()
    )


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a file with one integer per line; other lines are skipped."""
    ids = read_lines(spark, path).select(parse_int(F.col("value")).alias("id"))
    return ids.where(F.col("id").isNotNull()).distinct()


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(id, name)``: stripped lines with their line number."""
    return number_lines(read_lines(spark, path)).select(
        F.col("line_no").alias("id"), strip(F.col("value")).alias("name")
    )
