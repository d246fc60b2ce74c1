"""Page popularity: from view-log lines to pages ranked by summed views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.cells import count_shard_name, hash_shard
from linkloom.functions.views import count_field, is_decodable, last_field, project_of, title_of
from linkloom.functions.text import is_internal, parse_int
from linkloom.operators.lookup import lookup_join
from linkloom.operators.positions import in_file_order, with_positions
from linkloom.runtime import ship_package, written

# Above this many rows a top-n is cut by position; below, each task sends its own top n to one task.
SMALL_TOP = 1_000


def rank_order() -> list[Column]:
    """Count descending; equal counts by title."""
    return [F.desc("count"), F.asc("page_title")]


def _in_project(project: str) -> Column:
    return F.col("value").startswith(project + " ")


def filter_project(lines: DataFrame, project: str = "en") -> DataFrame:
    """Lines of one project; runs on the raw line, before any decoding."""
    return lines.where(_in_project(project))


def first_project_run(lines: DataFrame, project: str = "en") -> DataFrame:
    """Per file, only the first unbroken run of lines of the project.

    On files sorted by project this equals :func:`filter_project`. Lines are read once: each split of a file
    keeps its own first run and says whether that run begins and ends with the split. Of these few rows, one per split and
    project run, the ones that make up the file's first run are found.
    """
    ship_package(lines.sparkSession)
    kept = lines.select(F.col("value").cast("binary").alias("value"), "file", "block", "slot")
    runs = written(kept.mapInArrow(split_runs(project), _RUNS), "project-runs")
    # One row per split with lines.
    splits = runs.groupBy("file", "block").agg(
        F.bool_or("mine").alias("some"), F.bool_or(F.col("mine") & F.col("first")).alias("at_begin"),
        (~F.bool_or(~F.col("mine") & ~F.col("first"))).alias("to_end")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.bool_or("some").over(before), F.lit(False))
    # The run of a split goes on in the next one if it reaches the end there and the next begins with the project.
    last = F.lag("to_end").over(Window.partitionBy("file").orderBy("block"))
    joins = splits.withColumn("begun", begun).withColumn("linked", F.col("at_begin") & F.coalesce(last, F.lit(False)))
    upto = Window.partitionBy("file").orderBy("block")
    whole = F.bool_and(~F.col("begun") | F.col("linked")).over(upto)
    chosen = joins.withColumn("whole", whole).where("some and whole").select("file", "block")
    mine = runs.where("mine").select(F.col("value").cast("string").alias("value"), "file", "block", "slot")
    return lookup_join(mine, written(chosen, "chosen-splits"), ["file", "block"], "left_semi", spread_by=["slot"])


_RUNS = "value binary, file string, block bigint, slot bigint, mine boolean, first boolean"


def split_runs(project: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first run of each split, and rows that are not ``mine``: for a run that ended, and, as ``first``, for lines before any.

    Lines come as :func:`linkloom.sources.lines.read_lines` gives them, those of a split one after the other in one task. Of
    the run, ``first`` is the line that begins the split.
    """
    begin = f"{project} ".encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, begun, ended, told = None, False, False, False
        for batch in batches:
            mine = pc.starts_with(batch.column("value"), pattern=begin).to_numpy(zero_copy_only=False)
            place = pa.array(batch.column("file")).dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
            cuts = np.flatnonzero((place[0][1:] != place[0][:-1]) | (place[1][1:] != place[1][:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(mine)]):
                if a == b:
                    continue
                here = (batch.column("file")[int(a)].as_py(), batch.column("block")[int(a)].as_py())
                fresh = here != split
                if fresh:
                    split, begun, ended, told = here, False, False, False
                if ended:
                    continue
                own = mine[a:b]
                low = 0 if begun else int(np.argmax(own)) if own.any() else len(own)
                rest = own[low:]
                high = low + (int(np.argmin(rest)) if not rest.all() else len(rest))
                first = np.zeros(high - low, dtype=bool)
                if fresh and low == 0 and high > low:
                    first[0] = True
                if high > low:
                    yield _run_rows(batch.slice(int(a) + low, high - low), True, first)
                    begun = True
                ended = begun and high < len(own)
                if ended:
                    yield _run_rows(batch.slice(int(a) + high, 1), False, np.zeros(1, dtype=bool))
                elif not begun and not told:
                    # A split without the project so far is still one that parts its neighbours.
                    yield _run_rows(batch.slice(int(a), 1), False, np.ones(1, dtype=bool))
                    told = True

    return run


def _run_rows(rows: pa.RecordBatch, mine: bool, first: np.ndarray) -> pa.RecordBatch:
    flags = [pa.array(np.full(len(first), mine)), pa.array(first)]
    return pa.RecordBatch.from_arrays([*(rows.column(n) for n in ("value", "file", "block", "slot")), *flags], ["value", "file", "block", "slot", "mine", "first"])


def decode_pageviews(lines: DataFrame, on_error: str = "fail", keep: Sequence[str] = ()) -> DataFrame:
    """``(project, page_title, count, last)`` and the columns to ``keep``; a line that cannot be decoded fails or is dropped."""
    line = F.col("value")
    good = is_decodable(line)
    if on_error == "drop":
        lines, count = lines.where(good), parse_int(count_field(line))
    elif on_error == "fail":
        message = F.concat(F.lit("Invalid input: "), line)
        count = F.when(good, parse_int(count_field(line))).otherwise(F.raise_error(message).cast("bigint"))
    else:
        raise ValueError(f"on_error must be 'fail' or 'drop', not {on_error!r}")
    return lines.select(
        project_of(line).alias("project"),
        title_of(line).alias("page_title"),
        count.alias("count"),
        parse_int(last_field(line)).alias("last"),
        *keep,
    )


def undecodable_lines(lines: DataFrame) -> DataFrame:
    """The lines which ``decode_pageviews(..., on_error="drop")`` leaves out."""
    return lines.where(~is_decodable(F.col("value")))


def drop_internal(pages: DataFrame) -> DataFrame:
    """Drop talk, user, file and other pages which are not articles."""
    return pages.where(~is_internal(F.col("page_title")))


def drop_internal_ranked(lines: DataFrame) -> DataFrame:
    """The same on finished ``title<TAB>count`` lines."""
    return lines.where(~is_internal(F.col("value")))


def shard_filter(pages: DataFrame, shard: int, shards: int, key: str = "page_title") -> DataFrame:
    """Only the keys of one shard, for a partial run."""
    return pages.where(hash_shard(F.col(key), shards) == shard)


def sum_by_title(pageviews: DataFrame) -> DataFrame:
    """``(page_title, count)``; partial sums are formed before the shuffle."""
    return pageviews.groupBy("page_title").agg(F.sum("count").alias("count"))


def distinct_pages(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("pages"))


def rank_desc(counts: DataFrame) -> DataFrame:
    return counts.orderBy(*rank_order())


def rank_line() -> Column:
    """``title<TAB>count``."""
    return F.concat_ws("\t", "page_title", F.col("count").cast("string"))


def with_count_shard(counts: DataFrame, shards: int) -> DataFrame:
    """Add the name of the shard file a title belongs to."""
    return counts.withColumn("shard", count_shard_name(hash_shard(F.col("page_title"), shards), shards))


def merge_ranked(lines: DataFrame) -> DataFrame:
    """Ranked lines of any number of files as one ranking by the integer after the last tab.

    Equal lines are kept; their place in the files lets several tasks sort them.
    """
    key = parse_int(F.substring_index("value", "\t", -1))
    bad = F.raise_error(F.concat(F.lit("No count at the end of: "), F.col("value"))).cast("bigint")
    counted = lines.withColumn("count", F.coalesce(key, bad))
    return in_file_order(counted, F.desc("count"), F.asc("value")).select("value", "count")


def top_n_pages(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most viewed pages; a negative ``n`` means all.

    A small ``n`` is taken per task and then merged. For a large one that merge would
    be a single heavy task: instead a count is found which at least ``n`` pages reach,
    and only those pages are sorted, in ranges, and cut by position.
    """
    if n < 0:
        return rank_desc(counts)
    if n <= SMALL_TOP:
        return rank_desc(counts).limit(n)
    return _top_by_position(counts, n)


def _top_by_position(counts: DataFrame, n: int) -> DataFrame:
    # Read twice below; without this, so would be all the logs.
    counts = written(counts, "counts")
    # Pages per count value: N different values need about N*N/2 views, so this stays small.
    per_count = counts.groupBy("count").agg(F.count(F.lit(1)).alias("_pages"))
    reached = F.sum("_pages").over(Window.orderBy(F.desc("count")))
    enough = per_count.withColumn("_reached", reached).where(F.col("_reached") >= n)
    floor = enough.agg(F.max("count")).first()[0]
    candidates = counts if floor is None else counts.where(F.col("count") >= floor)
    placed = with_positions(candidates, *rank_order(), name="_place")
    return placed.where(F.col("_place") < n).drop("_place").orderBy(*rank_order())
