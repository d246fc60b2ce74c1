"""Queries on page popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.catalog.inputs import Inputs, write_files
from linkloom.catalog.oracle import INTERNAL, crc32, query
from linkloom.catalog.registry import register
from linkloom.functions.cells import cell_shard_name, count_shard_name, hash_shard
from linkloom.functions.text import parse_int
from linkloom.operators import ranking as op
from linkloom.operators.positions import number_lines
from linkloom.operators.pruning import candidates, narrowed, ranked_candidates, summarise
from linkloom.plans.popularity import count_pages, most_viewed, page_views, rank_pages
from linkloom.plans.popularity_state import ranking, update_ranking
from linkloom.runtime import new_path, written
from linkloom.sources import lines as source
from linkloom.sources import sinks

SHARDS = 8
TOP = 100
# Few titles kept by each task, so that most are forgotten; a skewed log is summarised anew by more where they say too little.
FEW, COUNTERS, SKEWED_COUNTERS = 3, 200, 128
_LEAST = f"select min(count) as least from (select count from counts order by count desc limit {FEW})"


@register("scan_pageviews", query("select value from views", "views"))
def scan_pageviews(t: Inputs) -> DataFrame:
    return source.scan_pageviews(t.spark, t.view_files()).select("value")


@register("scan_skip_corrupt", query("select value from views where hour >= 6", "views"))
def scan_skip_corrupt(t: Inputs) -> DataFrame:
    return source.scan_pageviews(t.spark, t.view_files(broken_below=6), skip_corrupt=True).select("value")


@register(
    "skipped_files",
    query("select distinct format('pageviews-{}-{:02d}0000.gz', 20190101 + day, hour) as name from views where hour < 6", "views"),
)
def skipped_files(t: Inputs) -> DataFrame:
    return source.skipped_files(t.spark, t.view_files(broken_below=6)).select(F.substring_index("file", "/", -1).alias("name"))


@register("decode_pageview", query("select * from decoded", "decoded"))
def decode_pageview(t: Inputs) -> DataFrame:
    return op.decode_pageviews(t.views)


_INT_TEXT = """case l_linenumber when 1 then cast(l_orderkey as string) when 2 then concat('+', cast(l_orderkey as string))
  when 3 then concat('-', cast(l_orderkey as string)) when 4 then concat(' ', cast(l_orderkey as string))
  when 5 then concat(cast(l_orderkey as string), '.0') when 6 then concat(cast(l_orderkey as string), 'x') else '' end"""


@register(
    "parse_int",
    f"""select text, case when regexp_full_match(text, '[+-]?[0-9]+') then try_cast(text as bigint) end as number
        from (select {_INT_TEXT} as text from lineitem)""",
)
def parse_int_query(t: Inputs) -> DataFrame:
    texts = t.base("lineitem").select(F.expr(_INT_TEXT).alias("text"))
    return texts.select("text", parse_int(F.col("text")).alias("number"))


@register("filter_project", query("select value from views where starts_with(value, 'en ')", "views"))
def filter_project(t: Inputs) -> DataFrame:
    return op.filter_project(t.views, "en").select("value")


@register(
    "first_project_run",
    query(
        """select value from (
             select *, min(case when not mine and n > first then n end) over (partition by day, hour) as stop from (
               select *, min(case when mine then n end) over (partition by day, hour) as first from (
                 select day, hour, value, starts_with(value, 'en ') as mine,
                   row_number() over (partition by day, hour order by part, value) as n from views)))
           where mine and (stop is null or n < stop)""",
        "views",
    ),
)
def first_project_run(t: Inputs) -> DataFrame:
    return op.first_project_run(source.scan_pageviews(t.spark, t.view_files()), "en").select("value")


@register(
    "drop_internal",
    query(f"select page_title, count from decoded where not regexp_matches(page_title, '{INTERNAL}')", "decoded"),
)
def drop_internal(t: Inputs) -> DataFrame:
    return op.drop_internal(op.decode_pageviews(t.views)).select("page_title", "count")


@register(
    "drop_internal_ranked",
    query(
        f"""select concat(page_title, chr(9), sum(count)::BIGINT::VARCHAR) as value from decoded
            where not regexp_matches(page_title, '{INTERNAL}') group by page_title""",
        "decoded",
    ),
)
def drop_internal_ranked(t: Inputs) -> DataFrame:
    counts = op.sum_by_title(op.decode_pageviews(t.views))
    return op.drop_internal_ranked(counts.select(op.rank_line().alias("value")))


@register("hash_shard", query(f"select page_id, {crc32('page_id::VARCHAR')} % 32 as shard from page", "page"))
def hash_shard_query(t: Inputs) -> DataFrame:
    return t.page.select("page_id", hash_shard(F.col("page_id"), 32).alias("shard"))


@register("shard_filter", query(f"select page_id, page_title from page where {crc32('page_id::VARCHAR')} % 4 = 1", "page"))
def shard_filter(t: Inputs) -> DataFrame:
    return op.shard_filter(t.page, 1, 4, "page_id").select("page_id", "page_title")


@register(
    "shard_name",
    query(
        """select page_id, format('pagecounts-{:03d}-of-{:03d}', page_id % 32, 32) as count_shard,
             format('data.bin.{:05d}-of-{:05d}', page_id % 64, 64) as cell_shard from page""",
        "page",
    ),
)
def shard_name(t: Inputs) -> DataFrame:
    key = F.col("page_id")
    return t.page.select(
        key, count_shard_name(key % 32, 32).alias("count_shard"), cell_shard_name(key % 64, 64).alias("cell_shard")
    )


@register("sum_by_title", query("select page_title, sum(count)::BIGINT as count from decoded group by page_title", "decoded"))
def sum_by_title(t: Inputs) -> DataFrame:
    return op.sum_by_title(op.decode_pageviews(t.views))


@register("distinct_pages", query("select count(*) as pages from counts", "counts"))
def distinct_pages(t: Inputs) -> DataFrame:
    return op.distinct_pages(count_pages(t.views))


@register("rank_desc", query("select page_title, count from counts order by count desc, page_title", "counts"))
def rank_desc(t: Inputs) -> DataFrame:
    return op.rank_desc(count_pages(t.views))


@register("top_n_pages", query(f"select page_title, count from counts order by count desc, page_title limit {TOP}", "counts"))
def top_n_pages(t: Inputs) -> DataFrame:
    return op.top_n_pages(count_pages(t.views), TOP)


@register("top_n_pruned", query(f"select page_title, count from counts order by count desc, page_title limit {TOP}", "counts"))
def top_n_pruned(t: Inputs) -> DataFrame:
    return most_viewed(t.views, TOP)


@register("view_bounds", query(f"select page_title, count, true as bounded, count >= least as kept from counts, ({_LEAST})", "counts"))
def view_bounds(t: Inputs) -> DataFrame:
    """Of every title, whether its count lies within the bounds, and whether it is kept if it is among the first."""
    summary = summarise(page_views(t.views), COUNTERS)
    titles = candidates(summary, FEW).titles
    counts = written(count_pages(t.views), "counts")
    least = op.top_n_pages(counts, FEW).agg(F.min("count")).first()[0]
    rows = counts.join(summary.bounds, "page_title", "left")
    if titles is not None:
        rows = rows.join(titles.withColumn("chosen", F.lit(True)), "page_title", "left")
    chosen = F.lit(True) if titles is None else F.coalesce("chosen", F.lit(False))
    upper = F.coalesce("excess", F.lit(0)) + F.lit(summary.floor)
    return rows.select(
        "page_title", "count", F.col("count").between(F.coalesce("lower", F.lit(0)), upper).alias("bounded"),
        (chosen & (F.col("count") >= F.lit(least))).alias("kept"),
    )


_SKEWED = "select cast(l_partkey >> (l_orderkey % 12) as string) as page_title, cast(l_quantity as bigint) as count from lineitem"
_LEVEL = "cast(shiftright(l_partkey, cast(l_orderkey % 12 as int)) as string) as page_title"


@register(
    "top_n_pruned_skewed",
    f"""select page_title, cast(sum(count) as bigint) as count, true as pruned from ({_SKEWED})
        group by page_title order by count desc, page_title limit {FEW}""",
)
def top_n_pruned_skewed(t: Inputs) -> DataFrame:
    """A log in which few titles have most views, by tasks that keep few at first; ``pruned`` if under half of all titles reach the shuffle."""
    views = t.base("lineitem").selectExpr(_LEVEL, "cast(l_quantity as bigint) as count")
    summary, chosen = narrowed(views, FEW, SKEWED_COUNTERS)
    shuffled = None if chosen.titles is None or chosen.exact else chosen.titles.count()
    titles = views.select("page_title").distinct().count()
    pruned = F.lit(shuffled is not None and 2 * shuffled < titles)
    return ranked_candidates(views, FEW, summary, chosen).withColumn("pruned", pruned)


@register("ranking_job", query("select page_title, count from counts", "counts"))
def ranking_job(t: Inputs) -> DataFrame:
    return rank_pages(source.scan_pageviews(t.spark, t.view_files()))


def _shard_files(t: Inputs) -> str:
    path = new_path(t.spark, "shard-counts")
    sinks.write_shard_counts(count_pages(t.views), path, SHARDS)
    return path


@register(
    "write_shard_counts",
    query(
        f"""select format('pagecounts-{{:03d}}-of-{{:03d}}', {crc32('page_title')} % {SHARDS}, {SHARDS}) as shard,
              concat(page_title, chr(9), count::VARCHAR) as value from counts""",
        "counts",
    ),
)
def write_shard_counts(t: Inputs) -> DataFrame:
    return t.spark.read.text(_shard_files(t)).select("shard", "value")


@register(
    "merge_ranked",
    query("select concat(page_title, chr(9), count::VARCHAR) as value, count from counts", "counts"),
)
def merge_ranked(t: Inputs) -> DataFrame:
    return op.merge_ranked(source.read_lines(t.spark, _shard_files(t)))


@register(
    "write_ranked",
    query(
        """select row_number() over (order by count desc, page_title) - 1 as line_no,
             concat(page_title, chr(9), count::VARCHAR) as value from counts""",
        "counts",
    ),
)
def write_ranked(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "ranked")
    sinks.write_ranked(written(count_pages(t.views), "counts"), path)
    return number_lines(source.read_lines(t.spark, path)).select("line_no", "value")


@register("incremental_ranking", query("select page_title, count from counts", "counts"))
def incremental_ranking(t: Inputs) -> DataFrame:
    """The ranking by updates: every other hour first, then the whole days, then all once more."""
    state, early = new_path(t.spark, "ranking-state"), new_path(t.spark, "early-logs")
    name = F.format_string("pageviews-%d-%02d0000.gz", F.col("day") + 20190101, "hour")
    lines = t.views.where("hour % 2 = 1").select(name.alias("name"), "part", "value", F.lit(False).alias("plain"))
    write_files(lines, early)
    # The early arrivals are other files of the same names, so the second update takes their counts away again.
    for logs in (early, t.view_files(), t.view_files()):
        update_ranking(t.spark, state, logs)
    return ranking(t.spark, state)
