"""Queries on dump files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.catalog.inputs import Inputs, place_columns, write_files
from linkloom.catalog.oracle import dump_lines, query
from linkloom.catalog.registry import register
from linkloom.functions.text import parse_int, text_to_bytes
from linkloom.operators import dumps as op
from linkloom.operators import long_lines
from linkloom.operators.positions import number_lines
from linkloom.plans.dump_filter import filter_dumps, filter_tuples
from linkloom.plans.files import filter_file
from linkloom.runtime import new_path, written
from linkloom.sources import lines as source
from linkloom.sources import sinks
from linkloom.sources.chunks import read_chunks

CHUNK_LINES = 100
RANGE_BYTES = 128 << 10

_TITLES = "select page_title from page where page_is_redirect = 0"
_IDS = "select page_id as id from page where page_namespace = 0"
_OTHERS = """select line * 2 as line_no, concat('-- block ', line::VARCHAR) as value from (select distinct line from {0}_lines)
  union all select max(line) * 2 + 2, '/* Footer */' from {0}_lines"""


def _titles(t: Inputs) -> DataFrame:
    return written(t.page.where(F.col("page_is_redirect") == 0).select("page_title"), "titles")


def _ids(t: Inputs) -> DataFrame:
    return written(t.page.where(F.col("page_namespace") == 0).select(F.col("page_id").alias("id")), "ids")


def _tuples(t: Inputs, table: str) -> DataFrame:
    return op.parse_dump_tuples(source.read_lines(t.spark, t.dump(table)))


@register("read_ranked_titles", query("select distinct page_title from page where page_id % 9 != 0", "page"))
def read_ranked_titles(t: Inputs) -> DataFrame:
    return source.read_ranked_titles(t.spark, t.ranked_file)


@register(
    "read_id_list",
    query("select distinct page_id as id from page where page_id % 7 not in (0, 1)", "page"),
)
def read_id_list(t: Inputs) -> DataFrame:
    return source.read_id_list(t.spark, t.id_file)


@register(
    "scan_dump",
    query(
        f"""select line * 2 + 1 as line_no, value from ({dump_lines('page', raw=True)})
            union all {_OTHERS.format('page')}
            union all select max(line) * 2 + 3, '' from page_lines""",
        "page_lines",
    ),
)
def scan_dump(t: Inputs) -> DataFrame:
    return source.scan_dump(t.spark, t.dump("page")).select("line_no", "value")


# Files whose names differ in length and hold numbers; the order is that of the list.
_FILES = ("aa.sql", "b.sql", "part-9.sql", "part-10.sql", "part-100.sql")
_FILE_CHUNK = 7
_FILE_LINE = "concat('INSERT INTO `page` VALUES (', cast(page_id as string), ');')"
_FILE_LINES = f"""select row_number() over (order by page_id % {len(_FILES)}, page_id) - 1 as line_no,
  {_FILE_LINE.replace('string', 'varchar')} as value, page_id::VARCHAR as id from page"""


@register(
    "file_order",
    query(
        f"""with lines as ({_FILE_LINES})
            select 'dump' as output, 0::BIGINT as chunk, line_no, value from lines
            union all select 'ids', 0, line_no, id from lines
            union all select 'chunks', line_no // {_FILE_CHUNK}, line_no % {_FILE_CHUNK}, value from lines
            union all select 'id chunks', line_no // {_FILE_CHUNK}, line_no % {_FILE_CHUNK}, id from lines""",
        "page",
    ).replace("with lines as", ", lines as", 1),
)
def file_order(t: Inputs) -> DataFrame:
    """A dump of several files through the filter job, with and without chunks."""
    name = F.element_at(F.array(*[F.lit(f) for f in _FILES]), (F.col("page_id") % len(_FILES) + 1).cast("int"))
    lines = t.page.select(name.alias("name"), F.col("page_id").alias("part"), F.expr(_FILE_LINE).alias("value"), F.lit(True).alias("plain"))
    folder = new_path(t.spark, "many-files")
    write_files(lines, folder)
    parts = []
    for label, size in (("", 0), ("chunk", _FILE_CHUNK)):
        dump, ids = new_path(t.spark, "ordered-dump"), new_path(t.spark, "ordered-ids")
        filter_file(t.spark, folder, dump, index_output=ids, chunk_size=size)
        for path, kind in ((dump, "chunks" if size else "dump"), (ids, "id chunks" if size else "ids")):
            # Read twice to number them: chunks are many files, so their lines are stored once.
            read = number_lines(written(read_chunks(t.spark, path), "chunk-lines") if size else source.read_lines(t.spark, path))
            chunk = F.col("chunk") if size else F.lit(0).cast("bigint")
            read = read.select("line_no", "value", chunk.alias("chunk"))
            first = F.min("line_no").over(Window.partitionBy("chunk"))
            parts.append(read.select(F.lit(kind).alias("output"), "chunk", (F.col("line_no") - first).alias("line_no"), "value"))
    return reduce(DataFrame.unionByName, parts)


@register("parse_dump_tuples", query("select * from page", "page"))
def parse_dump_tuples(t: Inputs) -> DataFrame:
    return op.as_table(_tuples(t, "page"), op.PAGE)


@register("parse_dump_ranges", query("select * from page", "page"))
def parse_dump_ranges(t: Inputs) -> DataFrame:
    """A dump of one line, cut into ranges."""
    return op.as_table(long_lines.parse_dump_ranges(t.spark, t.page_line, range_bytes=RANGE_BYTES), op.PAGE)


@register(
    "load_tables",
    query(
        """select 'page' as source, page_id as id, page_title as name from page
           union all select 'pagelinks', pl_from, pl_title from pagelinks
           union all select 'categorylinks', cl_from, cl_to from categorylinks""",
        "page", "pagelinks", "categorylinks",
    ),
)
def load_tables(t: Inputs) -> DataFrame:
    layouts = {"page": op.PAGE, "pagelinks": op.PAGELINKS, "categorylinks": op.CATEGORYLINKS}
    tables = {name: written(op.as_table(_tuples(t, name), layout), name) for name, layout in layouts.items()}

    def names(table: str, id_column: str, name_column: str) -> DataFrame:
        return tables[table].select(F.lit(table).alias("source"), F.col(id_column).alias("id"), F.col(name_column).alias("name"))

    rows = names("page", "page_id", "page_title").union(names("pagelinks", "pl_from", "pl_title"))
    return rows.union(names("categorylinks", "cl_from", "cl_to"))


@register(
    "tuple_fields",
    query(
        """select page_id as id, 8 as n_fields,
             concat(chr(39), replace(page_title, chr(39), concat(chr(92), chr(39))), chr(39)) as raw_title,
             page_title, '' as empty from page""",
        "page",
    ),
)
def tuple_fields(t: Inputs) -> DataFrame:
    return _tuples(t, "page").select(
        op.tuple_id().alias("id"),
        F.size("fields").alias("n_fields"),
        text_to_bytes(F.col("fields")[2]).alias("raw_title"),
        op.field(2).alias("page_title"),
        op.field(3).alias("empty"),
    )


@register(
    "filter_rules",
    query("select page_id as id, page_title from page where page_is_redirect = 0 and page_title like '%,%'", "page"),
)
def filter_rules(t: Inputs) -> DataFrame:
    rules = [
        op.FieldRule(4, lambda value: parse_int(value) == 0),
        op.FieldRule(2, lambda value: value.contains(",")),
        op.FieldRule(99, lambda value: value == "no tuple is that long, so all pass"),
    ]
    kept = op.filter_rules(op.require_int_key(_tuples(t, "page")), rules)
    return kept.select("id", op.field(2).alias("page_title"))


@register(
    "filter_main_ns",
    query("select pl_from as id, pl_title from pagelinks where pl_namespace = 0", "pagelinks"),
)
def filter_main_ns(t: Inputs) -> DataFrame:
    return op.filter_main_ns(_tuples(t, "pagelinks")).select(op.tuple_id().alias("id"), op.field(2).alias("pl_title"))


# Keys in several writings; only a plain integer counts.
_KEY_SQL = """case when page_id % 5 = 0 then concat(chr(39), cast(page_id as string), chr(39))
  when page_id % 5 = 1 then concat('x', cast(page_id as string)) else cast(page_id as string) end"""


@register("require_int_key", query("select page_id as id, page_title from page where page_id % 5 > 1", "page"))
def require_int_key(t: Inputs) -> DataFrame:
    title = F.concat(F.lit(",0,'"), F.replace("page_title", F.lit("'"), F.lit("''")), F.lit("');"))
    value = F.concat(F.lit("INSERT INTO `page` VALUES ("), F.expr(_KEY_SQL), title)
    lines = t.page.select(value.alias("value"), *place_columns(F.col("page_id")))
    return op.require_int_key(op.parse_dump_tuples(lines)).select("id", op.field(2).alias("page_title"))


@register(
    "pass_other_lines",
    query(f"select * from ({_OTHERS.format('pagelinks')})", "pagelinks_lines"),
)
def pass_other_lines(t: Inputs) -> DataFrame:
    return op.other_lines(source.scan_dump(t.spark, t.dump("pagelinks"))).select("line_no", "value")


@register(
    "drop_empty_insert",
    query(
        f"""select line * 2 + 1 as line_no, value from (
              {dump_lines('page', '(select * from page_lines where contains(page_title, chr(49) || chr(49)))')})""",
        "page_lines",
    ),
)
def drop_empty_insert(t: Inputs) -> DataFrame:
    tuples = op.parse_dump_tuples(source.scan_dump(t.spark, t.dump("page")))
    few = op.filter_rules(tuples, [op.FieldRule(2, lambda value: value.contains("11"))])
    return op.rebuild_inserts(few, ["line_no"])


@register("semi_by_id", query(f"select pl_from, pl_title from pagelinks where pl_from in ({_IDS})", "pagelinks"))
def semi_by_id(t: Inputs) -> DataFrame:
    kept = op.semi_by_id(_tuples(t, "pagelinks"), _ids(t))
    return kept.select(op.tuple_id().alias("pl_from"), op.field(2).alias("pl_title"))


_BY_TITLE = query(f"select pl_from, pl_title from pagelinks where pl_title in ({_TITLES})", "pagelinks")


def _links_by_title(t: Inputs, **limits: int) -> DataFrame:
    kept = op.semi_by_title(_tuples(t, "pagelinks"), _titles(t), **limits)
    return kept.select(op.tuple_id().alias("pl_from"), op.field(2).alias("pl_title"))


@register("semi_by_title", _BY_TITLE)
def semi_by_title(t: Inputs) -> DataFrame:
    return _links_by_title(t)


@register("semi_by_title_large", _BY_TITLE)
def semi_by_title_large(t: Inputs) -> DataFrame:
    """The same as if the titles were too many to broadcast and popular ones had too many links for a task."""
    return _links_by_title(t, broadcast_bytes=1 << 10, hot_rows=500)


_FILTERED = f"""(select * from pagelinks_lines where pl_namespace = 0
  and pl_from in ({_IDS}) and pl_title in ({_TITLES}))"""


def _filtered_links(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Numbered lines of the link dump, and its surviving tuples."""
    lines = source.scan_dump(t.spark, t.dump("pagelinks"))
    return lines, written(filter_tuples(lines, titles=_titles(t), ids=_ids(t)), "link-tuples")


@register(
    "write_filtered_dump",
    query(
        f"""select row_number() over (order by line_no) - 1 as line_no, value from (
              select line * 2 + 1 as line_no, value from ({dump_lines('pagelinks', _FILTERED)})
              union all {_OTHERS.format('pagelinks')})""",
        "pagelinks_lines",
    ),
)
def write_filtered_dump(t: Inputs) -> DataFrame:
    lines, tuples = _filtered_links(t)
    path = new_path(t.spark, "filtered")
    sinks.write_dump(op.rebuild_dump(lines, tuples), path)
    return number_lines(source.read_lines(t.spark, path)).select("line_no", "value")


@register(
    "write_ids",
    query(
        f"select row_number() over (order by pos) - 1 as line_no, pl_from::VARCHAR as value from {_FILTERED}",
        "pagelinks_lines",
    ),
)
def write_ids(t: Inputs) -> DataFrame:
    path = new_path(t.spark, "ids")
    sinks.write_ids(op.tuple_ids(_filtered_links(t)[1]), path)
    return number_lines(source.read_lines(t.spark, path)).select("line_no", "value")


_CHUNKED = f"""select line_no // {CHUNK_LINES} as chunk, value from (
  select line * 2 + 1 as line_no, value from ({dump_lines('pagelinks', _FILTERED)})
  union all {_OTHERS.format('pagelinks')})"""


@register("chunk_dump", query(f"select chunk::BIGINT as chunk, value from ({_CHUNKED})", "pagelinks_lines"))
def chunk_dump(t: Inputs) -> DataFrame:
    lines, tuples = _filtered_links(t)
    path = new_path(t.spark, "chunks")
    rebuilt = op.rebuild_dump(lines, tuples, ["line_no"])
    sinks.write_dump_chunks(op.with_chunk(rebuilt, CHUNK_LINES), path)
    return t.spark.read.schema("value string, chunk bigint").text(path).select("chunk", "value")


@register(
    "skip_chunks",
    query(f"select chunk::BIGINT as chunk, value from ({_CHUNKED}) where chunk >= 1", "pagelinks_lines"),
)
def skip_chunks(t: Inputs) -> DataFrame:
    lines, tuples = _filtered_links(t)
    rebuilt = op.with_chunk(op.rebuild_dump(lines, tuples, ["line_no"]), CHUNK_LINES)
    return op.skip_chunks(rebuilt, 1).select("chunk", "value")


@register(
    "dump_job",
    query(
        f"""select 'page' as source, page_id as id, page_title as name from page
              where page_namespace = 0 and page_title in ({_TITLES})
            union all select 'pagelinks', pl_from, pl_title from pagelinks
              where pl_namespace = 0 and pl_title in ({_TITLES})
                and pl_from in (select page_id from page where page_namespace = 0 and page_title in ({_TITLES}))
            union all select 'categorylinks', cl_from, cl_to from categorylinks
              where cl_from in (select page_id from page where page_namespace = 0 and page_title in ({_TITLES}))""",
        "page", "pagelinks", "categorylinks",
    ),
)
def dump_job(t: Inputs) -> DataFrame:
    texts = (source.read_lines(t.spark, t.dump(table)) for table in ("page", "pagelinks", "categorylinks"))
    done = filter_dumps(*texts, titles=_titles(t))

    def names(table: str, tuples: DataFrame, position: int) -> DataFrame:
        return tuples.select(F.lit(table).alias("source"), "id", op.field(position).alias("name"))

    links = names("pagelinks", done.pagelinks, 2).union(names("categorylinks", done.categorylinks, 1))
    return names("page", done.page, 2).union(links)


