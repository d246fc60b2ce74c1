"""The ranking job: view-log lines to pages by summed views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linkloom.operators.pruning import top_n_pruned
from linkloom.operators.ranking import decode_pageviews, drop_internal, filter_project, sum_by_title, top_n_pages


def page_views(lines: DataFrame, project: str = "en", on_error: str = "fail") -> DataFrame:
    """``(page_title, count)`` of each line of one project that is about no internal page."""
    return drop_internal(decode_pageviews(filter_project(lines, project), on_error)).select("page_title", "count")


def count_pages(lines: DataFrame, project: str = "en", on_error: str = "fail") -> DataFrame:
    """``(page_title, count)`` of one project without internal pages."""
    return sum_by_title(drop_internal(decode_pageviews(filter_project(lines, project), on_error)))


def most_viewed(lines: DataFrame, limit: int, project: str = "en", on_error: str = "fail") -> DataFrame:
    """The same as :func:`rank_pages`, reading the lines twice instead of shuffling titles that cannot be among the first."""
    return top_n_pruned(page_views(lines, project, on_error), limit)


def rank_pages(lines: DataFrame, project: str = "en", limit: int = -1, on_error: str = "fail") -> DataFrame:
    """The ``limit`` most viewed pages of a project, all of them if negative."""
    return top_n_pages(count_pages(lines, project, on_error), limit)
