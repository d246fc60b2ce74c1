"""The most viewed pages by summaries: the same as by counting all titles, whatever a task may keep."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.catalog.registry import QUERIES
from linkloom.operators import pruning as op
from linkloom.operators.ranking import rank_desc, sum_by_title
from linkloom.runtime import written

KINDS = "page_title string, count bigint"


def ranked(df):
    return [(r["page_title"], r["count"]) for r in df.collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 rows over some 9,000 titles of which few have most views, in 6 tasks."""
    ids = spark.range(60_000, numPartitions=6)
    title = F.floor(F.pow(F.lit(9_000.0), F.rand(3))).cast("bigint")
    rows = ids.select(F.concat(F.lit("page "), title).alias("page_title"), (1 + F.col("id") % 5).alias("count"))
    return written(rows, "views")


@pytest.mark.parametrize(("n", "counters"), [(1, 1), (5, 20), (10, 800), (50, 400), (50, 100_000), (300, 300), (8_999, 9_000)])
def test_equal_to_ranking_all(skewed, n, counters):
    assert ranked(op.top_n_pruned(skewed, n, counters)) == ranked(rank_desc(sum_by_title(skewed)).limit(n))


def test_bounds_hold_and_titles_are_dropped(skewed):
    summary = op.summarise(skewed, 800)
    true = dict(ranked(sum_by_title(skewed)))
    kept = {r["page_title"]: (r["lower"], r["excess"] + summary.floor) for r in summary.bounds.collect()}
    assert summary.floor > 0 and len(kept) < len(true)
    for title, count in true.items():
        low, high = kept.get(title, (0, summary.floor))
        assert low <= count <= high
    chosen = op.candidates(summary, 10)
    titles = {r["page_title"] for r in chosen.titles.collect()}
    assert 10 <= len(titles) < 100 < len(true)
    # What reaches the shuffle: at most the candidates, once a task.
    assert skewed.join(F.broadcast(chosen.titles), "page_title", "left_semi").select("page_title").distinct().count() == len(titles)
    assert set(sorted(true, key=lambda t: (-true[t], t))[:10]) <= titles


def test_ties_at_the_cut(spark):
    draw = random.Random(1)
    rows = [(f"t{i:03d}", 1) for i in range(400)] * 3 + [("hot", 50)]
    draw.shuffle(rows)
    views = written(spark.createDataFrame(rows, KINDS).repartition(5), "ties")
    for n in (1, 2, 37):
        for counters in (n, 60, 1000):
            assert ranked(op.top_n_pruned(views, n, counters)) == ranked(rank_desc(sum_by_title(views)).limit(n))


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [("a", 5), ("a", -4), ("b", 3), ("c", 2)],
        [("a", None), ("b", 3), ("c", 2), ("a", 1)],
        [(None, 9), ("b", 3), ("c", 2)],
        [("a", 1 << 50), ("b", 3), ("c", 0)],
        [("", 2), ("a\tb", 2), ("x" * 100_000, 2)],
    ],
)
def test_awkward_counts(spark, rows):
    views = written(spark.createDataFrame(rows, KINDS), "awkward")
    for n in (-1, 0, 1, 2, 20):
        want = ranked(rank_desc(sum_by_title(views)))
        assert ranked(op.top_n_pruned(views, n, 1)) == (want if n < 0 else want[:n])


def test_titles_that_are_not_utf8(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xff"), 3), (bytearray(b"a\xfe"), 2), (bytearray(b"a\xff"), 2)], "page_title binary, count bigint")
    views = written(rows.withColumn("page_title", F.col("page_title").cast("string")), "bytes")
    got = op.top_n_pruned(views, 1, 1).select(F.col("page_title").cast("binary").alias("t"), "count").collect()
    assert [(bytes(r["t"]), r["count"]) for r in got] == [(b"a\xff", 5)]


def test_wider_summaries_where_few_counters_say_too_little(spark, tmp_path):
    """Some two hundred titles share the first places, more than the query's tasks keep at first."""
    rows = spark.range(600_000, numPartitions=6).selectExpr(
        "id * 7919 % 400000 as l_partkey", "id * 31 as l_orderkey", "1.0D + id % 50 as l_quantity"
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["top_n_pruned_skewed"](spark, str(tmp_path)).collect()
    views = spark.read.parquet(f"{tmp_path}/lineitem.parquet").selectExpr(
        "cast(shiftright(l_partkey, cast(l_orderkey % 12 as int)) as string) as page_title", "cast(l_quantity as bigint) as count"
    )
    assert op.candidates(op.summarise(views, 128), 3).titles is None
    assert [(r["page_title"], r["count"]) for r in got] == ranked(rank_desc(sum_by_title(views)).limit(3))
    assert all(r["pruned"] for r in got)
