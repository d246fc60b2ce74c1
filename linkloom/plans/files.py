"""Jobs from files to files. Outputs are folders; their part files follow the order of the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.cells import hash_shard
from linkloom.operators import dumps as op
from linkloom.operators.factors import export_vectors, fit_embeddings
from linkloom.operators.links import MIN_LINKS, build_cells, matrix_shape
from linkloom.operators.positions import in_file_order, with_positions
from linkloom.operators.ranking import (
    drop_internal_ranked, filter_project, merge_ranked, shard_filter, top_n_pages, undecodable_lines,
)
from linkloom.plans.dump_filter import filter_tuples
from linkloom.plans.entity_vectors import make_dictionaries, training_cells
from linkloom.plans.popularity import count_pages
from linkloom.runtime import delete_path, written
from linkloom.sources import lines as source
from linkloom.sources import sinks
from linkloom.sources.coo import read_coo, write_coo


def rank_files(
    spark: SparkSession, input_path: str, output_path: str, project: str = "en", limit: int = -1,
    shards: int = 0, shard_id: int = -1, skip_corrupt: bool = False, on_error: str = "fail",
) -> None:
    """Hourly logs to ``pagecounts-summary``, and to ``pagecounts`` by shard if ``shards`` is given.

    ``shard_id`` makes only that shard, without a summary. What is left out is written too:
    names of broken files to ``skipped``, lines that cannot be decoded to ``rejected``.
    """
    lines = source.scan_pageviews(spark, input_path, skip_corrupt)
    if skip_corrupt:
        source.skipped_files(spark, input_path).write.csv(f"{output_path}/skipped", sep="\t")
    if on_error == "drop":
        rejected = undecodable_lines(filter_project(lines, project))
        rejected.select("value").write.text(f"{output_path}/rejected")
    counts = count_pages(lines, project, on_error)
    if shard_id >= 0:
        counts = shard_filter(counts, shard_id, shards)
    counts = written(counts, "counts")
    if shards:
        sinks.write_shard_counts(counts, f"{output_path}/pagecounts", shards)
    if shard_id < 0:
        sinks.write_ranked(top_n_pages(counts, limit), f"{output_path}/pagecounts-summary")


def merge_files(spark: SparkSession, input_path: str, output_path: str, limit: int = -1) -> None:
    """Ranked shard files to one ranking of at most ``limit`` lines."""
    merged = merge_ranked(source.read_lines(spark, input_path))
    if limit >= 0:
        place = "_place"
        slot = F.monotonically_increasing_id()
        stored = written(merged.withColumn("slot", slot), "merged")
        kept = with_positions(stored, "slot", name=place).where(F.col(place) < limit)
        sinks.write_lines(kept, output_path, "slot")
    else:
        merged.select("value").write.text(output_path)


def clean_file(spark: SparkSession, input_path: str, output_path: str) -> None:
    """A finished ranking without talk, user and other internal pages, in its order."""
    lines = drop_internal_ranked(source.read_lines(spark, input_path))
    sinks.write_ordered(in_file_order(lines), output_path)


def filter_file(
    spark: SparkSession, input_path: str, output_path: str, page_filter: str | None = None,
    index_filter: str | None = None, index_output: str | None = None, chunk_size: int = 0, skip: int = 0,
    on_error: str = "fail",
) -> None:
    """One dump to the lines about listed titles and ids, and to the ids of what is left.

    With ``on_error="drop"`` malformed inserts are left out and written to ``<output>-rejected``.
    """
    lines, place = source.read_lines(spark, input_path), list(op.PLACE)
    if chunk_size > 0 or skip > 0:
        numbered = source.scan_dump(spark, input_path)
        lines, place = op.skip_chunks(op.with_chunk(numbered, chunk_size), skip), ["line_no", "chunk"]
    titles = source.read_ranked_titles(spark, page_filter) if page_filter else None
    ids = source.read_id_list(spark, index_filter) if index_filter else None
    if on_error == "drop":
        op.malformed_inserts(lines).select("value").write.text(f"{output_path.rstrip('/')}-rejected")
    tuples = filter_tuples(lines, titles, ids, on_error)
    if index_output:
        # Both outputs need them.
        tuples = written(tuples.drop("fields"), "tuples")
    rebuilt = op.rebuild_dump(lines, tuples, place)
    if chunk_size > 0:
        sinks.write_dump_chunks(rebuilt, output_path)
    else:
        sinks.write_dump(rebuilt, output_path)
    if index_output and chunk_size > 0:
        sinks.write_id_chunks(tuples, index_output)
    elif index_output:
        sinks.write_ids(tuples, index_output)


def filter_files(
    spark: SparkSession, input_path: str, output_path: str, base: str, page_filter: str, chunk_size: int = 1000,
    on_error: str = "fail",
) -> None:
    """The dumps ``<base>-page.sql``, ``<base>-pagelinks.sql`` and ``<base>-categorylinks.sql``."""
    ids = f"{output_path}/page-indices.txt"

    def paths(table: str) -> tuple[str, str]:
        return f"{input_path}/{base}-{table}.sql", f"{output_path}/{base}-filtered-{table}.sql"

    filter_file(spark, *paths("page"), page_filter=page_filter, index_output=ids, on_error=on_error)
    filter_file(
        spark, *paths("pagelinks"), page_filter=page_filter, index_filter=ids, chunk_size=chunk_size, on_error=on_error
    )
    filter_file(spark, *paths("categorylinks"), index_filter=ids, on_error=on_error)


def load_dump(spark: SparkSession, path: str, table: str, output_path: str) -> DataFrame:
    """A dump as a typed Parquet table; ``table`` is page, pagelinks or categorylinks."""
    layout = {"page": op.PAGE, "pagelinks": op.PAGELINKS, "categorylinks": op.CATEGORYLINKS}[table]
    op.as_table(op.parse_dump_tuples(source.read_lines(spark, path)), layout).write.parquet(output_path)
    return spark.read.parquet(output_path)


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    page, pagelinks, categorylinks = (spark.read.parquet(f"{folder}/{t}") for t in ("page", "pagelinks", "categorylinks"))
    return page, pagelinks, categorylinks


def _dictionaries(spark: SparkSession, page_dictionary: str, category_file: str) -> tuple[DataFrame, DataFrame]:
    pages, categories = (source.read_dictionary(spark, path) for path in (page_dictionary, category_file))
    return written(pages, "page-dictionary"), written(categories, "category-dictionary")


def count_files(
    spark: SparkSession, tables: str, page_dictionary: str, category_file: str, min_links: int = MIN_LINKS
) -> None:
    """Tables to the two dictionaries."""
    names = make_dictionaries(*_tables(spark, tables), min_links)
    sinks.write_names(names.pages, page_dictionary, "id")
    sinks.write_names(names.categories, category_file, "id")


def matrix_files(
    spark: SparkSession, tables: str, page_dictionary: str, category_file: str, output_path: str, shards: int = 32,
    shard_id: int = -1, binary: bool = False,
) -> None:
    """Tables and dictionaries to cells, sharded by a hash of the row; with ``shard_id`` only that shard."""
    cells = build_cells(*_tables(spark, tables), *_dictionaries(spark, page_dictionary, category_file))
    if shard_id >= 0:
        cells = shard_filter(cells, shard_id, shards, "row")
    _write_matrix(cells.withColumn("shard", hash_shard(F.col("row"), shards)), output_path, shards, binary)


def zero_files(
    spark: SparkSession, input_path: str, page_dictionary: str, category_file: str, output_path: str,
    shards: int = 64, factor: float = 1.0, binary: bool = False,
) -> None:
    """Cells to deduplicated cells and zeros, sharded by row block."""
    shape = matrix_shape(*_dictionaries(spark, page_dictionary, category_file))
    _write_matrix(training_cells(_read_matrix(spark, input_path), shape, shards, factor), output_path, shards, binary)


def _write_matrix(cells: DataFrame, path: str, shards: int, binary: bool) -> None:
    # The range sort of the Parquet writer samples its input first, which would run the joins twice.
    cells = written(cells, "cells")
    if binary:
        write_coo(cells, path, shards)
    else:
        sinks.write_cells(cells, path)


def _read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a Parquet folder or of a folder of binary shard files."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "data.bin.*-of-*").load(path).select("path")
    cells = spark.read.parquet(path) if names.isEmpty() else written(read_coo(spark, path), "binary-cells")
    return cells.select("row", "col", "value")


def train_files(
    spark: SparkSession, matrix_path: str, page_dictionary: str, output_path: str, k: int = 100, epochs: int = 100,
    fresh: bool = False,
) -> None:
    """Cells to ``vectors.tsv``; weights and losses stay in the folder, and a further run goes on from them.

    With ``fresh`` it begins anew.
    """
    pages = written(source.read_dictionary(spark, page_dictionary), "page-dictionary")
    if fresh:
        for part in ("weights", "history"):
            delete_path(spark, f"{output_path}/{part}")
    training = fit_embeddings(_read_matrix(spark, matrix_path), k, epochs, folder=f"{output_path}/weights")
    training.history.write.mode("append").parquet(f"{output_path}/history")
    vectors = export_vectors(pages, training.factors.rows, k)
    sinks.write_lines(vectors, f"{output_path}/vectors.tsv", "id", mode="overwrite")
