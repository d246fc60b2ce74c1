"""A ranking that is kept up to date: each log file is counted once, when it first appears.

The folder of a state holds versions. A version has ``files``, the log files it added with their size and time of
change; ``deltas``, the counts of each of those files; and ``totals``, the counts of all files up to it. ``files`` is
written last, and a version without it does not exist, so an update that breaks off is done again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.lookup import lookup_join
from linkloom.operators.ranking import decode_pageviews, drop_internal, filter_project, top_n_pages
from linkloom.runtime import delete_path, exists, written
from linkloom.sources.lines import PAGEVIEW_FILE, read_lines

_FILES = "name string, length bigint, changed timestamp"
_DELTAS = "name string, page_title string, count bigint"
_TOTALS = "page_title string, count bigint"
# Versions whose totals are kept: the last one, and the one it was made from.
KEPT_TOTALS = 2


def versions(spark: SparkSession, state: str) -> list[int]:
    """The complete versions of a state, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/files")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and exists(spark, f"{state}/files/{n}/_SUCCESS"))


def _read(spark: SparkSession, state: str, part: str, kind: str, of: list[int]) -> DataFrame:
    if not of:
        return spark.createDataFrame([], f"{kind}, version int")
    paths = [f"{state}/{part}/version={v}" for v in of]
    return spark.read.schema(f"{kind}, version int").option("basePath", f"{state}/{part}").parquet(*paths)


def counted_files(spark: SparkSession, state: str) -> DataFrame:
    """``(name, length, changed, version)``: the log files counted, in the form in which they were counted last."""
    files = _read(spark, state, "files", _FILES, versions(spark, state))
    newest = files.groupBy("name").agg(F.max(F.struct("version", "length", "changed")).alias("f"))
    return newest.select("name", "f.length", "f.changed", "f.version")


def totals(spark: SparkSession, state: str) -> DataFrame:
    """``(page_title, count)`` over all files counted so far."""
    done = versions(spark, state)
    return _read(spark, state, "totals", _TOTALS, done[-1:]).drop("version")


def update_ranking(spark: SparkSession, state: str, logs: str, project: str = "en", on_error: str = "fail") -> DataFrame:
    """Count what is new among the hourly logs in a folder; returns the ``(name, length, changed)`` that were.

    A file is known by its name. One counted before is not read again, in whichever order and however often
    files arrive; one whose size or time of change differs replaces its earlier counts. Files that have left the folder stay
    counted. The state belongs to one project. If nothing is new there is no new version.
    """
    seen = counted_files(spark, state)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "pageviews-*.gz").load(logs)
    name = F.substring_index("path", "/", -1)
    listed = listed.select(name.alias("name"), "path", "length", F.col("modificationTime").alias("changed"))
    listed = listed.where(F.col("path").rlike(PAGEVIEW_FILE))
    # An update adds one row per new log file.
    fresh = written(listed.join(seen, ["name", "length", "changed"], "left_anti"), "fresh-files")
    paths = [r["path"] for r in fresh.select("path").collect()]
    if not paths:
        return fresh.drop("path")
    done = versions(spark, state)
    version = done[-1] + 1 if done else 0
    lines = read_lines(spark, paths)
    decoded = decode_pageviews(filter_project(lines, project).withColumn("_name", F.substring_index("file", "/", -1)), on_error, keep=("_name",))
    counts = drop_internal(decoded).groupBy(F.col("_name").alias("name"), "page_title").agg(F.sum("count").alias("count"))
    deltas = _save(counts, f"{state}/deltas/version={version}")
    # What a replaced file had counted is taken away; the newest counts of a file are those of its last version.
    replaced = seen.join(fresh.select("name"), "name", "left_semi").select("name", "version")
    deltas_before = _read(spark, state, "deltas", _DELTAS, done)
    before = lookup_join(deltas_before, written(replaced, "replaced"), ["name", "version"], "left_semi", spread_by=["page_title"])
    gone = before.select("page_title", (-F.col("count")).alias("count"), F.lit(-1).alias("files"))
    # Titles that no file holds any more go; those counted as nothing stay, as they do when all files are counted at once.
    old = _read(spark, state, "totals", f"{_TOTALS}, files bigint", done[-1:]).select("page_title", "count", "files")
    added = deltas.select("page_title", "count", F.lit(1).alias("files"))
    new = old.unionByName(added).unionByName(gone).groupBy("page_title").agg(F.sum("count").alias("count"), F.sum("files").alias("files"))
    _save(new.where("files > 0"), f"{state}/totals/version={version}")
    _save(fresh.select("name", "length", "changed"), f"{state}/files/version={version}")
    if len(done) >= KEPT_TOTALS:
        delete_path(spark, f"{state}/totals/version={done[-KEPT_TOTALS]}")
    return fresh.drop("path")


def _save(df: DataFrame, path: str) -> DataFrame:
    # A version that broke off is written anew.
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranking(spark: SparkSession, state: str, limit: int = -1) -> DataFrame:
    """The ``limit`` most viewed pages of all files counted so far, all of them if negative."""
    return top_n_pages(totals(spark, state), limit)
