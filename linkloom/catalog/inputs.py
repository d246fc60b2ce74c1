"""View logs, link tables and dumps derived from the given tables.

The SQL below runs unchanged in Spark and in the checking engine. On the Spark side
each result is written once per session and data folder, and read from there.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.cells import div
from linkloom.operators.links import build_cells
from linkloom.operators.positions import with_positions
from linkloom.operators.zeros import dedupe_cells
from linkloom.plans.entity_vectors import Dictionaries, make_dictionaries, training_cells
from linkloom.runtime import new_path, ship_package, written
from linkloom.sources.coo import open_path

THRESHOLD = 50
TUPLES_PER_LINE = 50
SHARDS = 4

# One view-log line per line item; every title form occurs: plain, with spaces, internal.
VIEWS_SQL = """
select concat_ws(' ', case l_returnflag when 'A' then 'en' when 'N' then 'en.m' else 'de' end,
         case when p_size % 10 = 0 then concat('User_talk:', p_name)
              when p_size % 10 = 1 then concat('special:', p_name)
              when p_size % 10 = 2 then concat(p_name, ' (', cast(p_partkey as string), ')')
              else concat(replace(p_name, ' ', '_'), '_(', cast(p_partkey as string), ')') end,
         cast(cast(l_quantity as int) as string), cast(l_linenumber as string)) as value,
       cast(floor(l_orderkey / 20000) as int) as day, l_suppkey % 24 as hour, l_linenumber as part
from lineitem join part on l_partkey = p_partkey
"""

# One page per part; titles are unique and hold quotes, commas and parentheses.
PAGE_SQL = """
select p_partkey as page_id, case when p_size % 7 = 0 then 1 else 0 end as page_namespace,
       concat(replace(p_name, ' ', '_'),
              case when p_size % 3 = 0 then concat(chr(39), 's_') when p_size % 3 = 1 then ',_' else '_' end,
              '(', cast(p_partkey as string), ')') as page_title,
       case when p_size % 5 = 0 then 1 else 0 end as page_is_redirect
from part
"""

# One link per line item; a tenth of them point to forty popular pages.
PAGELINKS_SQL = """
select l.l_partkey as pl_from, t.page_namespace as pl_namespace, t.page_title as pl_title,
       f.page_namespace as pl_from_namespace
from (select l_partkey, (l_orderkey * 31 + l_linenumber * 7919)
               % (case when l_quantity <= 5 then 40 else (select count(*) from part) end) as target
      from lineitem) l
join page f on f.page_id = l.l_partkey join page t on t.page_id = l.target
"""

# Brand and type of each part, and one category per twenty pages that is named like a page.
CATEGORYLINKS_SQL = """
select p_partkey as cl_from, p_brand as cl_to from part
union all select p_partkey, p_type from part
union all select f.page_id, t.page_title from page f join page t on t.page_id = f.page_id - f.page_id % 20
"""

_QUOTE = "chr(39)"


def _quoted(column: str) -> str:
    return f"concat({_QUOTE}, replace({column}, {_QUOTE}, concat(chr(92), {_QUOTE})), {_QUOTE})"


# Text of one dump tuple, quotes in titles escaped.
PAGE_TUPLE_SQL = f"""concat('(', cast(page_id as string), ',', cast(page_namespace as string), ',',
  {_quoted('page_title')}, ',', {_QUOTE}, {_QUOTE}, ',', cast(page_is_redirect as string), ',0.5,',
  {_QUOTE}, '20190120003623', {_QUOTE}, ',NULL)')"""
PAGELINKS_TUPLE_SQL = f"""concat('(', cast(pl_from as string), ',', cast(pl_namespace as string), ',',
  {_quoted('pl_title')}, ',', cast(pl_from_namespace as string), ')')"""
CATEGORYLINKS_TUPLE_SQL = f"concat('(', cast(cl_from as string), ',', {_quoted('cl_to')}, ')')"

DUMPS = {
    "page": (PAGE_TUPLE_SQL, ["page_id"]),
    "pagelinks": (PAGELINKS_TUPLE_SQL, ["pl_from", "pl_namespace", "pl_title", "pl_from_namespace"]),
    "categorylinks": (CATEGORYLINKS_TUPLE_SQL, ["cl_from", "cl_to"]),
}

# Some lines with too many fields, as the reader must skip them.
RANKED_LINE_SQL = """case when page_id % 9 = 0 then concat(page_title, chr(9), '1', chr(9), '1')
  else concat(page_title, chr(9), cast(page_id as string)) end"""
# Some lines that are no integer.
ID_LINE_SQL = """case when page_id % 7 = 0 then concat('x', cast(page_id as string))
  when page_id % 7 = 1 then concat(' ', cast(page_id as string))
  when page_id % 7 = 2 then concat('+', cast(page_id as string)) else cast(page_id as string) end"""


_stored: dict[tuple[str, str, str], object] = {}


class Inputs:
    """Derived inputs of one data folder; each is made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _once(self, name: str, make):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stored:
            _stored[key] = make()
        return _stored[key]

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str, *views: str) -> DataFrame:
        for view in ("part", "lineitem"):
            self.base(view).createOrReplaceTempView(view)
        for view in views:
            getattr(self, view).createOrReplaceTempView(view)
        return self.spark.sql(text)

    def _table(self, name: str, text: str, *views: str) -> DataFrame:
        return self._once(name, lambda: written(self._sql(text, *views), name))

    @property
    def views(self) -> DataFrame:
        return self._table("views", VIEWS_SQL)

    @property
    def page(self) -> DataFrame:
        return self._table("page", PAGE_SQL)

    @property
    def pagelinks(self) -> DataFrame:
        return self._table("pagelinks", PAGELINKS_SQL, "page")

    @property
    def categorylinks(self) -> DataFrame:
        return self._table("categorylinks", CATEGORYLINKS_SQL, "page")

    def view_files(self, broken_below: int = 0) -> str:
        """Folder of hourly logs; hours below ``broken_below`` are not compressed, as the name promises."""

        def make() -> str:
            folder = new_path(self.spark, "view-logs")
            # One file per day and hour, so that their number grows with the data.
            name = F.format_string("pageviews-%d-%02d0000.gz", F.col("day") + 20190101, "hour")
            lines = self.views.select(name.alias("name"), "part", "value", (F.col("hour") < broken_below).alias("plain"))
            write_files(lines, folder)
            return folder

        return self._once(f"view-files-{broken_below}", make)

    def _text(self, name: str, lines: DataFrame, *order: str) -> str:
        def make() -> str:
            path = new_path(self.spark, name)
            lines.orderBy(*order).select("value").write.text(path)
            return path

        return self._once(name, make)

    def dump(self, table: str) -> str:
        """Dump text of a table: a comment before every insert line, then a footer and an empty line."""

        def make() -> str:
            text, order = DUMPS[table]
            # Columns are sorted, not texts: the text of a tuple is made when its line is put together.
            placed = with_positions(getattr(self, table), *order, name="pos")
            last = placed.agg(F.max("pos")).first()[0]
            tuples = placed.select(div(F.col("pos"), TUPLES_PER_LINE).alias("line"), "pos", F.expr(text).alias("tuple"))
            # Tuples move once: the ranges of lines that they are grouped in are also those in which the lines are written.
            grouped = tuples.repartitionByRange("line").groupBy("line").agg(F.array_sort(F.collect_list(F.struct("pos", "tuple"))).alias("t"))
            items = F.transform("t", lambda t: t["tuple"])
            # Some lines have blanks between their tuples.
            joined = F.when(F.col("line") % 3 == 1, F.array_join(items, " , ")).otherwise(F.array_join(items, ","))
            insert = F.concat(F.lit(f"INSERT INTO `{table}` VALUES "), joined, F.lit(";"))
            both = F.array(F.concat(F.lit("-- block "), F.col("line").cast("string")), insert)
            ends = F.array(F.lit("/* Footer */"), F.lit(""))
            is_last = F.col("line") == div(F.lit(last), TUPLES_PER_LINE)
            lines = grouped.sortWithinPartitions("line").select(F.explode(F.when(is_last, F.concat(both, ends)).otherwise(both)).alias("value"))
            path = new_path(self.spark, f"{table}-dump")
            lines.write.text(path)
            return path

        return self._once(f"dump-{table}", make)

    @property
    def page_line(self) -> str:
        """The page dump as one line of one file: tuples end with a comma, what follows the semicolon is no list."""

        def make() -> str:
            path = new_path(self.spark, "page-line")
            first, last = self.page.agg(F.min("page_id"), F.max("page_id")).first()
            head = F.when(F.col("page_id") == first, F.lit("INSERT INTO `page` VALUES ")).otherwise("")
            end = F.when(F.col("page_id") == last, F.lit(";")).otherwise("")
            rows = self.page.select("page_id", F.concat(head, F.expr(PAGE_TUPLE_SQL), end).alias("value"))
            # One line of one file has one writer.
            rows.repartition(1).sortWithinPartitions("page_id").select("value").write.option("lineSep", ",").text(path)
            return path

        return self._once("page-line", make)

    @property
    def ranked_file(self) -> str:
        return self._text("ranked", self.page.select("page_id", F.expr(RANKED_LINE_SQL).alias("value")), "page_id")

    @property
    def id_file(self) -> str:
        return self._text("ids", self.page.select("page_id", F.expr(ID_LINE_SQL).alias("value")), "page_id")

    @property
    def name_file(self) -> str:
        padded = F.concat(F.lit("  "), F.col("page_title"), F.lit(" "))
        return self._text("names", self.page.select("page_id", padded.alias("value")), "page_id")

    @property
    def dictionaries(self) -> Dictionaries:
        def make() -> Dictionaries:
            return make_dictionaries(self.page, self.pagelinks, self.categorylinks, THRESHOLD)

        return self._once("dictionaries", make)

    @property
    def cells(self) -> DataFrame:
        names = self.dictionaries
        return self._once(
            "cells",
            lambda: written(
                build_cells(self.page, self.pagelinks, self.categorylinks, names.pages, names.categories), "cells"
            ),
        )

    @property
    def positives(self) -> DataFrame:
        return self._once("positives", lambda: written(dedupe_cells(self.cells), "positives"))


    @property
    def training_cells(self) -> DataFrame:
        """Deduplicated cells with about as many zeros."""
        return self._once(
            "training-cells",
            lambda: written(training_cells(self.cells, self.dictionaries.shape(), SHARDS), "training-cells"),
        ).select("row", "col", "value")


def write_files(lines: DataFrame, folder: str) -> None:
    """Write ``value`` lines to the files ``name``, one task per file, in order of part and value."""
    ship_package(lines.sparkSession)
    ordered = lines.repartition("name").sortWithinPartitions("name", "part", "value")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_path(folder)
        filesystem.create_dir(base)
        name, sinks = None, []
        for batch in batches:
            for (file, plain), part in batch.groupby(["name", "plain"], sort=False):
                if file != name:
                    for sink in sinks:
                        sink.close()
                    name, sinks = file, [filesystem.open_output_stream(f"{base}/{file}", compression=None)]
                    if not plain:
                        sinks.insert(0, gzip.GzipFile(fileobj=sinks[0], mode="wb"))
                sinks[0].write(("\n".join(part["value"]) + "\n").encode())
        for sink in sinks:
            sink.close()
        yield pd.DataFrame({"files": [1]})

    ordered.mapInPandas(write, "files long").agg(F.sum("files")).collect()


def place_columns(slot: Column) -> list[Column]:
    """Place columns for lines that were not read from a file."""
    return [F.lit("table").alias("file"), F.lit(0).cast("bigint").alias("block"), slot.cast("bigint").alias("slot")]
