"""Link counts, dictionaries and the link matrix.

Tables: ``page(page_id, page_namespace, page_title, page_is_redirect)``,
``pagelinks(pl_from, pl_namespace, pl_title, pl_from_namespace)``,
``categorylinks(cl_from, cl_to)``; dictionaries are ``(id, name)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.cells import category_col, inlink_col, outlink_col
from linkloom.operators.dictionary import with_ids
from linkloom.operators.lookup import BROADCAST_BYTES, lookup_join
from linkloom.operators.positions import dense_ids
from linkloom.runtime import written

MIN_LINKS = 50


def _both_main() -> Column:
    return (F.col("pl_from_namespace") == 0) & (F.col("pl_namespace") == 0)


def drop_redirects(page: DataFrame) -> DataFrame:
    return page.where(F.col("page_is_redirect") == 0)


def count_outlinks(page: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """``page`` with ``outlinks``, the number of its links to any namespace."""
    counts = pagelinks.groupBy(F.col("pl_from").alias("page_id")).agg(F.count(F.lit(1)).alias("outlinks"))
    return page.join(counts, "page_id", "left").withColumn("outlinks", F.coalesce("outlinks", F.lit(0)))


def count_inlinks(page: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """``page`` with ``inlinks``, the number of links to its title within namespace 0."""
    counts = (
        pagelinks.where(_both_main())
        .groupBy(F.col("pl_title").alias("page_title"))
        .agg(F.count(F.lit(1)).alias("inlinks"))
    )
    return page.join(counts, "page_title", "left").withColumn("inlinks", F.coalesce("inlinks", F.lit(0)))


def min_links(counted: DataFrame, threshold: int = MIN_LINKS) -> DataFrame:
    return counted.where(F.col("inlinks") + F.col("outlinks") >= threshold)


def kept_pages(page: DataFrame, pagelinks: DataFrame, threshold: int = MIN_LINKS) -> DataFrame:
    """Pages that are no redirects and have enough links, with both counts."""
    own = drop_redirects(page).select("page_id", "page_title")
    return min_links(count_outlinks(count_inlinks(own, pagelinks), pagelinks), threshold)


def link_counts(page: DataFrame, pagelinks: DataFrame, threshold: int = MIN_LINKS) -> DataFrame:
    """The counts by namespace and title: inlinks must point into the page's own namespace."""
    inlinks = pagelinks.groupBy(
        F.col("pl_namespace").alias("page_namespace"), F.col("pl_title").alias("page_title")
    ).agg(F.count(F.lit(1)).alias("inlinks"))
    counted = (
        page.select("page_id", "page_namespace", "page_title")
        .join(inlinks, ["page_namespace", "page_title"], "left")
        .withColumn("inlinks", F.coalesce("inlinks", F.lit(0)))
    )
    counted = count_outlinks(counted, pagelinks).select("page_id", "page_title", "inlinks", "outlinks")
    return min_links(counted, threshold)


def page_dictionary(kept: DataFrame) -> DataFrame:
    """``(id, name)`` of the kept pages in the order of their page ids."""
    return dense_ids(kept.select("page_id", F.col("page_title").alias("name")), "page_id").select("id", "name")


def distinct_categories(kept: DataFrame, categorylinks: DataFrame) -> DataFrame:
    """``(name)``: categories with at least one kept page."""
    links = with_link_row(categorylinks.select(F.col("cl_from").alias("page_id"), F.col("cl_to").alias("name")))
    own = lookup_join(links, kept.select("page_id"), ["page_id"], "left_semi", spread_by=["_row"])
    return own.select("name").distinct()


def category_pages(kept: DataFrame, categorylinks: DataFrame) -> DataFrame:
    """``(cl_to)``: categories named like a kept page."""
    names = kept.select(F.col("page_title").alias("cl_to"))
    return categorylinks.select("cl_to").distinct().join(names, "cl_to", "left_semi")


def name_ids(dictionary: DataFrame) -> DataFrame:
    """One row per name; a repeated name has its last id."""
    return dictionary.groupBy("name").agg(F.max("id").alias("id"))


def lookup_id(names: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``id`` to a column ``name``: its id in the dictionary, -1 if unknown."""
    ids = written(name_ids(dictionary), "name-ids")
    return with_ids(with_link_row(names), ids, "name", ["_row"], broadcast_bytes).drop("_row")


def in_dictionary(page: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(page_id, page_title, id)``: pages whose title is in the dictionary."""
    ids = written(name_ids(dictionary), "title-ids")
    found = with_ids(page.select("page_id", "page_title"), ids, "page_title", ["page_id"], broadcast_bytes)
    return found.where("id >= 0").select("page_id", "page_title", "id")


def lookup_title(pagelinks: DataFrame, page: DataFrame) -> DataFrame:
    """Links with ``from_title``, the title of the page they start from; dangling ones go."""
    titles = page.select(F.col("page_id").alias("pl_from"), F.col("page_title").alias("from_title"))
    return lookup_join(with_link_row(pagelinks), titles, ["pl_from"], spread_by=["_row"]).drop("_row")


def with_link_row(links: DataFrame) -> DataFrame:
    """Number the rows of a stored table, so that equal rows can still be told apart."""
    return links.withColumn("_row", F.monotonically_increasing_id())


def join_inlinks(page: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """``(page_id, page_title, pl_from)``: links within namespace 0 to each page title."""
    links = with_link_row(pagelinks.where(_both_main()).select("pl_from", F.col("pl_title").alias("page_title")))
    joined = lookup_join(links, page.select("page_id", "page_title"), ["page_title"], spread_by=["_row"])
    return joined.select("page_id", "page_title", "pl_from")


def join_outlinks(page: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """``(page_id, page_title, pl_title)``: all links from each page."""
    links = with_link_row(pagelinks.select(F.col("pl_from").alias("page_id"), "pl_title"))
    joined = lookup_join(links, page.select("page_id", "page_title"), ["page_id"], spread_by=["_row"])
    return joined.select("page_id", "page_title", "pl_title")


def join_categories(page: DataFrame, categorylinks: DataFrame) -> DataFrame:
    """``(page_id, page_title, cl_to)``: the categories of each page."""
    links = with_link_row(categorylinks.select(F.col("cl_from").alias("page_id"), "cl_to"))
    joined = lookup_join(links, page.select("page_id", "page_title"), ["page_id"], spread_by=["_row"])
    return joined.select("page_id", "page_title", "cl_to")


@dataclass(frozen=True)
class Shape:
    rows: int
    cols: int


def matrix_shape(pages: DataFrame, categories: DataFrame) -> Shape:
    """P rows; P inlink, P outlink and C category columns."""
    rows = pages.count()
    return Shape(rows, 2 * rows + categories.count())


def build_cells(
    page: DataFrame, pagelinks: DataFrame, categorylinks: DataFrame, pages: DataFrame, categories: DataFrame
) -> DataFrame:
    """``(row, col, value)``: one cell per link of each of the three families, repeats kept.

    ``pages`` and ``categories`` are written dictionaries. The link table is read
    once: a link between dictionary pages meets one lookup row for the outlink cell of
    its start, and one per page of that title for the inlink cells of its end.
    """
    size = pages.count()
    known = written(in_dictionary(page, pages), "known-pages")
    starts = known.select(F.col("page_id").alias("pl_from"), F.col("id").alias("_start"))
    as_outlink = name_ids(pages).select(
        F.col("name").alias("pl_title"), F.col("id").alias("_end"), F.lit(True).alias("_out")
    )
    as_inlink = known.select(F.col("page_title").alias("pl_title"), F.col("id").alias("_end"), F.lit(False))
    ends = written(as_outlink.union(as_inlink), "link-ends")
    links = with_link_row(pagelinks.select("pl_from", "pl_title", _both_main().alias("_main")))
    links = lookup_join(links, starts, ["pl_from"], spread_by=["_row"])
    links = lookup_join(links, ends, ["pl_title"], spread_by=["_row"], counted=pagelinks)
    links = links.where(F.col("_out") | F.col("_main"))
    start, end, out = F.col("_start"), F.col("_end"), F.col("_out")
    page_cells = links.select(
        F.when(out, start).otherwise(end).alias("row"),
        F.when(out, outlink_col(end, size)).otherwise(inlink_col(start)).alias("col"),
    )

    kinds = written(name_ids(categories).withColumnRenamed("id", "_category"), "category-ids")
    tagged = with_link_row(categorylinks.select(F.col("cl_from").alias("pl_from"), F.col("cl_to").alias("name")))
    tagged = lookup_join(tagged, starts, ["pl_from"], spread_by=["_row"])
    names = categorylinks.select(F.col("cl_to").alias("name"))
    tagged = lookup_join(tagged, kinds, ["name"], spread_by=["_row"], counted=names)
    category_cells = tagged.select(F.col("_start").alias("row"), category_col(F.col("_category"), size).alias("col"))
    return page_cells.unionByName(category_cells).withColumn("value", F.lit(1.0).cast("float"))
