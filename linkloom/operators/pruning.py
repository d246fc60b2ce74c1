"""The most viewed pages without shuffling the others, by Space-Saving summaries.

1. Each task keeps a summary of at most ``counters`` titles of its rows. A kept title has a ``lower`` bound of its
   views in the task and an ``excess``; a title that is not kept has at most ``floor`` views there, a kept one at most ``floor + excess``.
2. Summaries add up: over all tasks a title has at least its summed ``lower`` views, and at most the summed floors and its summed
   excess. The ``n``-th largest lower bound is a number of views that at least ``n`` titles reach.
3. Only titles whose upper bound reaches that number are counted in a second pass over the rows. All other rows are dropped before the
   shuffle. Titles with as many views as the last one reach the bound too, so ties are decided as in the full ranking.

Where the summaries say too little (the summed floors reach the bound), wider ones are made, up to the number of titles that a task may keep. Where these
say too little as well, or a count is missing, negative or very large, all titles are counted. The result is the same in every case. Where no task had to forget a title, the lower bounds are the counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.lookup import lookup_join
from linkloom.operators.ranking import sum_by_title, top_n_pages
from linkloom.runtime import ship_package, written

# Titles that a task keeps for each one asked for, and at least: some megabytes a task. The summed floors are at most
# all views divided by this number; by the usual skew the n-th title has one view in n times the logarithm of the number of titles.
COUNTERS_PER_PAGE = 32
LEAST_COUNTERS = 1 << 15
# Beyond this many pages the summaries would not fit a task well: all titles are counted.
MOST_PAGES = 10_000

_PARTIAL = pa.schema([("page_title", pa.binary()), ("lower", pa.int64()), ("excess", pa.int64())])
_SUMMARY = "page_title binary, lower bigint, excess bigint, floor bigint, fits boolean"
# Sums of a task stay far from 64 bits if its counts and bounds stay below these.
_MOST_COUNT, _MOST_BOUND = 1 << 40, 1 << 61


class Summary(NamedTuple):
    """``bounds(page_title, lower, excess)`` of the kept titles; any other title has at most ``floor`` views.

    ``fits`` is false if the counts allow no bounds.
    """

    bounds: DataFrame
    floor: int
    fits: bool


class Candidates(NamedTuple):
    """Titles that may be among the first ``n``, or None if all may; ``least`` views are reached by ``n`` titles."""

    titles: DataFrame | None
    least: int | None
    exact: bool


def task_summary(counters: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``page_title, lower, excess`` of one task, and a row with its ``floor``."""

    def folded(held: list[pa.Table], floor: int) -> tuple[pa.Table, int]:
        table = pa.concat_tables(held).group_by("page_title").aggregate([("lower", "sum"), ("excess", "sum")])
        table = table.select(["page_title", "lower_sum", "excess_sum"]).rename_columns(_PARTIAL.names)
        if len(table) <= counters:
            return table, floor
        order = pc.sort_indices(table, [("excess", "descending"), ("page_title", "ascending")])
        # The largest of those that go bounds all titles that are not kept.
        forgotten = table.column("excess")[order[counters].as_py()].as_py()
        kept = table.take(order[:counters])
        return kept.set_column(2, "excess", pc.subtract(kept.column("excess"), forgotten)), floor + forgotten

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, floor, fits = [_PARTIAL.empty_table()], 0, 0, True
        for batch in batches:
            counts = batch.column("count")
            good = counts.null_count == 0 and batch.column("page_title").null_count == 0
            span = pc.min_max(counts).as_py() if good and len(batch) else {"min": 0, "max": 0}
            if not good or span["min"] < 0 or span["max"] > _MOST_COUNT:
                fits = False
            if not fits:
                continue
            held.append(pa.Table.from_arrays([batch.column("page_title"), counts, counts], schema=_PARTIAL))
            size += len(batch)
            if size >= counters:
                table, floor = folded(held, floor)
                held, size = [table], 0
                fits = floor + (pc.max(table.column("excess")).as_py() or 0) < _MOST_BOUND
        table, floor = folded(held, floor) if fits else (_PARTIAL.empty_table(), 0)
        n = len(table)
        last = pa.RecordBatch.from_pylist(
            [{"page_title": None, "lower": 0, "excess": 0, "floor": floor, "fits": fits}],
            pa.schema([*_PARTIAL, ("floor", pa.int64()), ("fits", pa.bool_())]),
        )
        if n:
            rows = table.append_column("floor", pa.nulls(n, pa.int64())).append_column("fits", pa.nulls(n, pa.bool_()))
            yield from rows.combine_chunks().to_batches(10_000)
        yield last

    return run


def summarise(pageviews: DataFrame, counters: int) -> Summary:
    """One summary of all rows of ``pageviews(page_title, count)``: at most ``counters`` rows a task are shuffled."""
    ship_package(pageviews.sparkSession)
    rows = pageviews.select(F.col("page_title").cast("binary").alias("page_title"), F.col("count").cast("bigint").alias("count"))
    parts = written(rows.mapInArrow(task_summary(counters), _SUMMARY), "view-summaries")
    total = parts.where("floor is not null").agg(
        F.coalesce(F.sum("floor"), F.lit(0)).alias("floor"), F.coalesce(F.bool_and("fits"), F.lit(True)).alias("fits")
    ).first()
    kept = parts.where("floor is null").groupBy("page_title").agg(F.sum("lower").alias("lower"), F.sum("excess").alias("excess"))
    bounds = kept.select(F.col("page_title").cast("string").alias("page_title"), "lower", "excess")
    return Summary(written(bounds, "view-bounds"), total["floor"], total["fits"])


def candidates(summary: Summary, n: int) -> Candidates:
    """The titles that may be among the ``n`` most viewed."""
    if not summary.fits:
        return Candidates(None, None, False)
    if summary.floor == 0:
        return Candidates(summary.bounds.select("page_title"), None, True)
    first = summary.bounds.select("lower").orderBy(F.desc("lower")).limit(n)
    row = first.agg(F.count(F.lit(1)).alias("rows"), F.min("lower").alias("least")).first()
    if row["rows"] < n or summary.floor >= row["least"]:
        return Candidates(None, row["least"], False)
    reach = summary.bounds.where(F.col("excess") + F.lit(summary.floor) >= F.lit(row["least"]))
    return Candidates(written(reach.select("page_title"), "candidate-titles"), row["least"], False)


def narrowed(pageviews: DataFrame, n: int, counters: int) -> tuple[Summary, Candidates]:
    """A summary of ``counters`` titles a task and its candidates; a wider one where that says too little.

    Floors shrink as a summary widens, at least by its width in rows that are spread evenly. So the next is as wide as the bound
    asks for, eight times as wide at least, and never wider than ``LEAST_COUNTERS`` and ``COUNTERS_PER_PAGE`` allow.
    """
    most = max(LEAST_COUNTERS, COUNTERS_PER_PAGE * n)
    while True:
        summary = summarise(pageviews, counters)
        chosen = candidates(summary, n)
        if chosen.titles is not None or not summary.fits or counters >= most:
            return summary, chosen
        wanted = 2 * counters * summary.floor // max(1, chosen.least or 1)
        counters = min(most, max(8 * counters, wanted))


def ranked_candidates(pageviews: DataFrame, n: int, summary: Summary, chosen: Candidates) -> DataFrame:
    """The ``n`` most viewed pages by a second pass over the rows of the chosen titles."""
    if chosen.exact:
        return top_n_pages(summary.bounds.select("page_title", F.col("lower").alias("count")), n)
    if chosen.titles is not None:
        # Titles that are dropped here are in no shuffle. A candidate that is hot is summed within tasks first.
        pageviews = lookup_join(
            pageviews.select("page_title", "count"), chosen.titles, ["page_title"], "left_semi", stored=False
        )
    return top_n_pages(sum_by_title(pageviews), n)


def top_n_pruned(pageviews: DataFrame, n: int, counters: int | None = None) -> DataFrame:
    """The ``n`` most viewed pages of ``pageviews(page_title, count)``, which is read twice or more; a negative ``n`` means all.

    Equal to ranking the sums of all titles. ``counters`` is the number of titles that a task keeps at first.
    """
    if n <= 0 or n > MOST_PAGES:
        return top_n_pages(sum_by_title(pageviews), n)
    first = max(n, counters or max(LEAST_COUNTERS, COUNTERS_PER_PAGE * n))
    return ranked_candidates(pageviews, n, *narrowed(pageviews, n, first))
