"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.lookup import lookup_join
from linkloom import runtime
from linkloom.runtime import delete_path, new_path

__all__ = [
    "attach", "column", "columns", "drop_documents", "first_rows", "fresh", "ids_not_kept", "new_path", "packed", "passing", "ship_package", "table", "written",
]

# A lookup is broadcast up to this measured size; a larger one is joined by key.
BROADCAST_BYTES = 8 << 20
# Keys of a join by key with more rows than this are cut into slices.
HOT_ROWS = 100_000


# What Spark hands to a Python task at once, if the session leaves it at Spark's own values: texts are long.
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b"),
}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the tasks, and their batches small enough for texts."""
    runtime.ship_package(spark)
    for key, (default, smaller) in BATCH_LIMITS.items():
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, smaller)


_written: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the folder all executors share, and go on from the stored copy."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete the tables written inside, but for those put in the list, once they have served."""
    first, kept = len(_written), []
    yield kept
    stay = {name.split("://", 1)[-1].removeprefix("file:") for df in kept for name in df.inputFiles()}
    for path in _written[first:]:
        bare = path.split("://", 1)[-1].removeprefix("file:")
        if not any(bare.lstrip("/") in name for name in stay):
            delete_path(spark, path)
    del _written[first:]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def attach(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
    spread_by: Sequence[str] | None = None, hot_rows: int = HOT_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``facts`` joined with ``lookup``: a measured broadcast, or by key with hot keys in slices.

    ``hot`` may name the hot keys with their ``_rows``, where they are known already.
    """
    return lookup_join(facts, lookup, on, how, spread_by, hot=hot, broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)


def ids_not_kept(decisions: DataFrame, id_col: str, kept: Column) -> DataFrame:
    """Ids of the documents of which no row is kept, written."""
    fate = decisions.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(kept).alias("_kept"))
    return written(fate.where(~F.col("_kept")).select(id_col), "dropped-ids")


def packed(docs: DataFrame, *keys: str | Column) -> DataFrame:
    """``row, *keys``: whole rows in one column, so that their other columns meet no name used on the way."""
    return docs.select(F.struct(*columns(docs)).alias("row"), *keys)


def drop_documents(docs: DataFrame, dropped: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the documents in ``dropped``, a written table of ids. A null id is in no such table."""
    return attach(packed(docs, id_col), dropped, [id_col], "left_anti", spread_by=[id_col]).select("row.*")


def first_rows(docs: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """One row of each group of rows equal in ``keys``; partial aggregates, so a large group is no problem."""
    row = fresh(docs, "_row_value")
    names = [f"{row}_{i}" for i in range(len(keys))]
    whole = F.first(F.struct(*columns(docs))).alias(row)
    groups = docs.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)]).agg(whole)
    return groups.select(f"{row}.*")
