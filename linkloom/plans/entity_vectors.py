"""The embedding job: link tables to dictionaries, cells, zeros, vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.cells import row_block
from linkloom.operators.factors import Training, export_vectors, fit_embeddings
from linkloom.operators.links import (
    MIN_LINKS,
    Shape,
    build_cells,
    distinct_categories,
    kept_pages,
    matrix_shape,
    page_dictionary,
)
from linkloom.operators.positions import dense_ids
from linkloom.operators.zeros import SEED, dedupe_cells, inject_zeros, union_zeros
from linkloom.runtime import written


@dataclass(frozen=True)
class Dictionaries:
    """Written tables ``(id, name)``."""

    pages: DataFrame
    categories: DataFrame

    def shape(self) -> Shape:
        return matrix_shape(self.pages, self.categories)


def make_dictionaries(
    page: DataFrame, pagelinks: DataFrame, categorylinks: DataFrame, threshold: int = MIN_LINKS
) -> Dictionaries:
    """Pages with enough links, by page id, and their categories, by name."""
    kept = written(kept_pages(page, pagelinks, threshold), "kept-pages")
    pages = written(page_dictionary(kept), "page-dictionary")
    categories = written(dense_ids(distinct_categories(kept, categorylinks), "name"), "category-dictionary")
    return Dictionaries(pages, categories)


def training_cells(cells: DataFrame, shape: Shape, shards: int, factor: float = 1.0, seed: int = SEED) -> DataFrame:
    """``(shard, row, col, value)``: deduplicated cells and zeros, one shard per row block."""
    total = cells.count()
    positives = written(dedupe_cells(cells), "positive-cells")
    zeros = inject_zeros(positives, shape, shards, total, factor, seed)
    joined = union_zeros(positives, zeros)
    return joined.select(row_block(F.col("row"), shape.rows, shards).alias("shard"), "row", "col", "value")


@dataclass(frozen=True)
class EntityVectors:
    dictionaries: Dictionaries
    training: Training
    vectors: DataFrame


def entity_vectors(
    page: DataFrame,
    pagelinks: DataFrame,
    categorylinks: DataFrame,
    threshold: int = MIN_LINKS,
    shards: int = 64,
    factor: float = 1.0,
    k: int = 100,
    epochs: int = 100,
    folder: str | None = None,
) -> EntityVectors:
    """``vectors`` is ``(id, value)``, one tab-separated line per page of the dictionary."""
    names = make_dictionaries(page, pagelinks, categorylinks, threshold)
    cells = written(build_cells(page, pagelinks, categorylinks, names.pages, names.categories), "cells")
    given = written(training_cells(cells, names.shape(), shards, factor), "training-cells")
    training = fit_embeddings(given.select("row", "col", "value"), k, epochs, folder=folder)
    return EntityVectors(names, training, export_vectors(names.pages, training.factors.rows, k))
