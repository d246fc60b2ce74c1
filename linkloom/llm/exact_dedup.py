"""Exact dedup with a heavy-hitter split.

Misra-Gries counters find the digests that may hold more than a share of all rows; an exact
count verifies them. These winners, fewer than ``1 / support`` of them, are broadcast, and
their copies are resolved where they are read. Only the other digests are shuffled, counted by partial aggregates, and
those that several rows have are joined back by digest, in slices where they still have many rows.

Defined results: a null text counts as empty, and empty texts are copies of one another. Of
equal texts the row with the largest id stays; a null id is smaller than any other. Of rows
that repeat both id and text exactly one stays, whichever comes first in the stored digests.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import HOT_ROWS, attach, columns, drop_documents, first_rows, fresh, ids_not_kept, table, written

# A digest with more than this share of all rows is resolved by broadcast.
SUPPORT = 0.001

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def normalised(text: Column) -> Column:
    """The text with A to Z in lower case and nothing else changed; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    # lower() changes other letters too, so it only serves texts of one byte per character.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def heavy_hitters(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``text_sha256, keep, group_size`` of the digests with more than ``support`` of the rows."""
    counters = digests.stat.freqItems(["text_sha256"], support)
    candidates = counters.select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    counted = digests.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256").agg(_best(), _size())
    return written(counted.where(F.col("group_size") > support * digests.count()), "heavy-digests")


def _best() -> Column:
    return F.max(F.struct("doc_id", F.negative("row").alias("row"))).alias("keep")


def _size() -> Column:
    return F.count(F.lit(1)).alias("group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"))
    digests = written(digests.withColumn("row", F.monotonically_increasing_id()), "digests")
    winners = heavy_hitters(digests, support)
    heavy = digests.join(F.broadcast(winners), "text_sha256")
    others = digests.join(F.broadcast(winners), "text_sha256", "left_anti")
    # Counted with partial aggregates; a digest with many rows all the same is joined in slices.
    groups = written(others.groupBy("text_sha256").agg(_best(), _size()).where("group_size > 1"), "equal-digests")
    hot = groups.where(F.col("group_size") > HOT_ROWS).select("text_sha256", F.col("group_size").alias("_rows"))
    others = attach(others, groups, ["text_sha256"], "left", spread_by=["row"], hot=hot)
    alone = F.struct("doc_id", F.negative("row").alias("row"))
    others = others.withColumn("keep", F.when(F.col("group_size").isNull(), alone).otherwise(F.col("keep")))
    others = others.withColumn("group_size", F.coalesce("group_size", F.lit(1)))
    return heavy.unionByName(others).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.negative("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with one document of each group of equal texts.

    A document goes if another with the same text and a larger id stays. Rows that repeat
    an id and its text are reduced to one; rows without id are left alone.
    """
    decisions = written(exact_dedup(docs), "exact-decisions")
    dropped = ids_not_kept(decisions, "doc_id", F.col("kept"))
    repeats = decisions.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "text_sha256").count().where("count > 1")
    again = written(repeats.select("doc_id").distinct(), "repeated-ids")
    stay = drop_documents(docs, dropped, "doc_id")
    if again.isEmpty():
        return stay
    known = again.withColumn(fresh(docs, "_again"), F.lit(True))
    marked = stay.join(known, "doc_id", "left").select(*columns(docs), known.columns[1])
    single = first_rows(marked.where(F.col(known.columns[1])).select(*columns(docs)), [F.col("doc_id"), digest(F.col("text"))])
    return marked.where(F.col(known.columns[1]).isNull()).select(*columns(docs)).unionByName(single)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP4_SQL = f"""
with digests as (
    select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256 from documents
)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, text_sha256
from digests
window same as (partition by text_sha256)
"""
