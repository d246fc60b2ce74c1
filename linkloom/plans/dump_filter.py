"""The dump job: keep what the three dumps say about the chosen pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from linkloom.operators.dumps import (
    filter_main_ns,
    parse_dump_tuples,
    require_int_key,
    semi_by_id,
    semi_by_title,
)
from linkloom.runtime import written


def filter_tuples(
    lines: DataFrame, titles: DataFrame | None = None, ids: DataFrame | None = None, on_error: str = "fail"
) -> DataFrame:
    """Tuples of a dump that are about ``ids.id`` and, in namespace 0, ``titles.page_title``."""
    tuples = require_int_key(parse_dump_tuples(lines, on_error))
    if titles is not None:
        tuples = filter_main_ns(tuples)
    if ids is not None:
        tuples = semi_by_id(tuples, ids)
    if titles is not None:
        tuples = semi_by_title(tuples, titles)
    return tuples


@dataclass(frozen=True)
class FilteredDumps:
    """Surviving tuples of each dump; ``page_ids`` are the ids of the kept pages."""

    page: DataFrame
    page_ids: DataFrame
    pagelinks: DataFrame
    categorylinks: DataFrame


def filter_dumps(
    page: DataFrame, pagelinks: DataFrame, categorylinks: DataFrame, titles: DataFrame, on_error: str = "fail"
) -> FilteredDumps:
    """Pages by title, then their links to such titles and their categories by id."""
    pages = written(filter_tuples(page, titles=titles, on_error=on_error), "page-tuples")
    ids = written(pages.select("id").distinct(), "page-ids")
    return FilteredDumps(
        page=pages,
        page_ids=ids,
        pagelinks=filter_tuples(pagelinks, titles=titles, ids=ids, on_error=on_error),
        categorylinks=filter_tuples(categorylinks, ids=ids, on_error=on_error),
    )
