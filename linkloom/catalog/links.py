"""Queries on link counts, dictionaries and the link matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.catalog.inputs import THRESHOLD, Inputs
from linkloom.catalog.oracle import query
from linkloom.catalog.registry import register
from linkloom.functions.cells import category_col, inlink_col, outlink_col, row_block
from linkloom.operators import links as op
from linkloom.operators.dictionary import compact_dictionary, decoded
from linkloom.operators.positions import dense_ids, number_lines
from linkloom.plans.entity_vectors import make_dictionaries
from linkloom.runtime import new_path, written
from linkloom.sources import lines as source
from linkloom.sources import sinks

BLOCKS = 8


@register("drop_redirects", query("select page_id, page_title from page where page_is_redirect = 0", "page"))
def drop_redirects(t: Inputs) -> DataFrame:
    return op.drop_redirects(t.page).select("page_id", "page_title")


@register(
    "count_outlinks",
    query("select page_id, (select count(*) from pagelinks where pl_from = page_id) as outlinks from page", "pagelinks"),
)
def count_outlinks(t: Inputs) -> DataFrame:
    return op.count_outlinks(t.page, t.pagelinks).select("page_id", "outlinks")


@register(
    "count_inlinks",
    query(
        """select page_id, (select count(*) from pagelinks where pl_from_namespace = 0 and pl_namespace = 0
             and pl_title = page_title) as inlinks from page""",
        "pagelinks",
    ),
)
def count_inlinks(t: Inputs) -> DataFrame:
    return op.count_inlinks(t.page, t.pagelinks).select("page_id", "inlinks")


@register("min_links", query("select page_id, page_title, inlinks, outlinks from kept", "kept"))
def min_links(t: Inputs) -> DataFrame:
    return op.kept_pages(t.page, t.pagelinks, THRESHOLD).select("page_id", "page_title", "inlinks", "outlinks")


@register(
    "link_counts",
    query(
        f"""select p.page_title, p.page_id, coalesce(ends.n, 0) as inlinks, coalesce(starts.n, 0) as outlinks
            from page p
            left join (select pl_title, pl_namespace, count(*) as n from pagelinks group by all) ends
              on ends.pl_title = p.page_title and ends.pl_namespace = p.page_namespace
            left join (select pl_from, count(*) as n from pagelinks group by all) starts on starts.pl_from = p.page_id
            where coalesce(ends.n, 0) + coalesce(starts.n, 0) >= {THRESHOLD}""",
        "page", "pagelinks",
    ),
)
def link_counts(t: Inputs) -> DataFrame:
    return op.link_counts(t.page, t.pagelinks, THRESHOLD)


@register("distinct_categories", query("select name from cats_dict", "cats_dict"))
def distinct_categories(t: Inputs) -> DataFrame:
    kept = written(op.kept_pages(t.page, t.pagelinks, THRESHOLD), "kept")
    return op.distinct_categories(kept, t.categorylinks)


@register(
    "category_pages",
    query(
        "select cl_to from categorylinks where exists (from kept where kept.page_title = cl_to) group by cl_to",
        "categorylinks", "kept",
    ),
)
def category_pages(t: Inputs) -> DataFrame:
    return op.category_pages(op.kept_pages(t.page, t.pagelinks, THRESHOLD), t.categorylinks)


@register("dense_ids", query("select row_number() over (order by page_title) - 1 as id, page_title from page", "page"))
def dense_ids_query(t: Inputs) -> DataFrame:
    return dense_ids(t.page.select("page_title"), "page_title")


@register(
    "read_dictionary",
    query("select row_number() over (order by page_id) - 1 as id, page_title as name from page", "page"),
)
def read_dictionary(t: Inputs) -> DataFrame:
    return source.read_dictionary(t.spark, t.name_file)


@register("write_page_dictionary", query("select id as line_no, name as value from pages_dict", "pages_dict"))
def write_page_dictionary(t: Inputs) -> DataFrame:
    names = make_dictionaries(t.page, t.pagelinks, t.categorylinks, THRESHOLD)
    path = new_path(t.spark, "page-names")
    sinks.write_names(names.pages, path, "id")
    return number_lines(source.read_lines(t.spark, path)).select("line_no", "value")


@register("write_categories", query("select id as line_no, name as value from cats_dict", "cats_dict"))
def write_categories(t: Inputs) -> DataFrame:
    kept = written(op.kept_pages(t.page, t.pagelinks, THRESHOLD), "kept")
    path = new_path(t.spark, "category-names")
    sinks.write_names(op.distinct_categories(kept, t.categorylinks), path, "name")
    return number_lines(source.read_lines(t.spark, path)).select("line_no", "value")


@register(
    "lookup_id",
    query("select page_title as name, coalesce(id, -1) as id from page left join pages_dict on name = page_title", "pages_dict"),
)
def lookup_id(t: Inputs) -> DataFrame:
    return op.lookup_id(t.page.select(F.col("page_title").alias("name")), t.dictionaries.pages)


@register("in_dictionary", query("select page_id, page_title, id from known", "known"))
def in_dictionary(t: Inputs) -> DataFrame:
    return op.in_dictionary(t.page, t.dictionaries.pages)


@register("compact_dictionary", query("select id, name from pages_dict", "pages_dict"))
def compact_dictionary_query(t: Inputs) -> DataFrame:
    """The names and ids that come back from the encoded dictionary."""
    return decoded(compact_dictionary(op.name_ids(t.dictionaries.pages)))


@register(
    "lookup_id_compact",
    query("select pl_from, pl_title, coalesce(id, -1) as id from pagelinks left join pages_dict on name = pl_title", "pagelinks", "pages_dict"),
)
def lookup_id_compact(t: Inputs) -> DataFrame:
    """Targets of all links by a dictionary that is taken as too large to be broadcast as a table."""
    links = t.pagelinks.select("pl_from", F.col("pl_title").alias("name"))
    return op.lookup_id(links, t.dictionaries.pages, broadcast_bytes=0).withColumnRenamed("name", "pl_title")


@register(
    "lookup_title",
    query("select pl_from, page_title as from_title, pl_title from pagelinks join page on page_id = pl_from", "pagelinks"),
)
def lookup_title(t: Inputs) -> DataFrame:
    return op.lookup_title(t.pagelinks, t.page).select("pl_from", "from_title", "pl_title")


@register(
    "join_inlinks",
    query(
        """select page_id, page_title, pl_from from page join pagelinks on pl_title = page_title
           where pl_from_namespace = 0 and pl_namespace = 0""",
        "pagelinks",
    ),
)
def join_inlinks(t: Inputs) -> DataFrame:
    return op.join_inlinks(t.page, t.pagelinks)


@register(
    "join_outlinks",
    query("select page_id, page_title, pl_title from page join pagelinks on pl_from = page_id", "pagelinks"),
)
def join_outlinks(t: Inputs) -> DataFrame:
    return op.join_outlinks(t.page, t.pagelinks)


@register(
    "join_categories",
    query("select page_id, page_title, cl_to from page join categorylinks on cl_from = page_id", "categorylinks"),
)
def join_categories(t: Inputs) -> DataFrame:
    return op.join_categories(t.page, t.categorylinks)


@register("matrix_shape", query('select p as "rows", c as "cols" from shape', "shape"))
def matrix_shape(t: Inputs) -> DataFrame:
    names = make_dictionaries(t.page, t.pagelinks, t.categorylinks, THRESHOLD)
    shape = names.shape()
    return t.spark.range(1).select(F.lit(shape.rows).cast("bigint").alias("rows"), F.lit(shape.cols).cast("bigint").alias("cols"))


@register(
    "col_offset",
    query(
        """select 'inlink' as family, id, id as col from pages_dict
           union all select 'outlink', id, id + (select p from shape) from pages_dict
           union all select 'category', id, id + 2 * (select p from shape) from cats_dict""",
        "shape",
    ),
)
def col_offset(t: Inputs) -> DataFrame:
    names = t.dictionaries
    size = names.shape().rows
    key = F.col("id")

    def family(name: str, ids: DataFrame, col) -> DataFrame:
        return ids.select(F.lit(name).alias("family"), "id", col.alias("col"))

    pages = family("inlink", names.pages, inlink_col(key)).union(family("outlink", names.pages, outlink_col(key, size)))
    return pages.union(family("category", names.categories, category_col(key, size)))


@register("row_block", query(f"select id, id // ((p - 1) // {BLOCKS} + 1) as block from pages_dict, shape", "shape"))
def row_block_query(t: Inputs) -> DataFrame:
    pages = t.dictionaries.pages
    return pages.select("id", row_block(F.col("id"), pages.count(), BLOCKS).alias("block"))


@register("union_link_families", query("select row, col, value from cells", "cells"))
def union_link_families(t: Inputs) -> DataFrame:
    names = t.dictionaries
    return op.build_cells(t.page, t.pagelinks, t.categorylinks, names.pages, names.categories)


@register(
    "write_coo",
    query(f"select row // ((p - 1) // {BLOCKS} + 1) as shard, row, col, value from cells, shape", "cells"),
)
def write_coo(t: Inputs) -> DataFrame:
    shape = t.dictionaries.shape()
    path = new_path(t.spark, "cells")
    sinks.write_cells(t.cells.withColumn("shard", row_block(F.col("row"), shape.rows, BLOCKS)), path)
    return t.spark.read.schema("row bigint, col bigint, value float, shard bigint").parquet(path).select("shard", "row", "col", "value")
