from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom.operators import links as op
from linkloom.operators import lookup
from linkloom.operators.lookup import frequent_keys, lookup_join, stored_bytes
from linkloom.operators.positions import dense_ids, with_positions
from linkloom.plans.entity_vectors import make_dictionaries
from linkloom.runtime import written

PAGES = [(1, 0, "A", 0), (2, 0, "B", 0), (3, 0, "C", 0), (4, 0, "R", 1), (5, 1, "A", 0), (6, 0, "Rare", 0)]
LINKS = [
    (1, 0, "B", 0), (1, 0, "C", 0), (1, 0, "C", 0), (2, 0, "A", 0), (2, 1, "A", 0), (3, 0, "A", 0), (3, 0, "Gone", 0),
    (5, 0, "A", 1), (5, 0, "B", 1), (99, 0, "A", 0), (4, 0, "A", 0), (2, 0, "C", 0), (3, 0, "B", 0),
]
CATEGORIES = [(1, "x"), (1, "y"), (2, "x"), (4, "only redirects"), (99, "dangling"), (3, "A")]


@pytest.fixture(scope="module")
def tables(spark):
    page = spark.createDataFrame(PAGES, "page_id long, page_namespace int, page_title string, page_is_redirect int")
    links = spark.createDataFrame(LINKS, "pl_from long, pl_namespace int, pl_title string, pl_from_namespace int")
    categories = spark.createDataFrame(CATEGORIES, "cl_from long, cl_to string")
    return written(page, "page"), written(links, "links"), written(categories, "categories")


def expected_kept(threshold):
    kept = []
    for page_id, _, title, redirect in PAGES:
        out = sum(f == page_id for f, *_ in LINKS)
        into = sum(t == title and ns == 0 and from_ns == 0 for _, ns, t, from_ns in LINKS)
        if not redirect and into + out >= threshold:
            kept.append((page_id, title))
    return kept


def expected_cells(names, categories):
    """The matrix by the definition: page by page, link by link; a repeated name has its last id."""
    size, ids = len(names), {n: i for i, n in enumerate(names)}
    category_ids = {c: i for i, c in enumerate(categories)}
    titles = {i: t for i, _, t, _ in PAGES}
    cells = []
    for page_id, _, title, _ in PAGES:
        if title not in ids:
            continue
        row = ids[title]
        for source, ns, target, from_ns in LINKS:
            if target == title and ns == 0 and from_ns == 0 and titles.get(source) in ids:
                cells.append((row, ids[titles[source]]))
            if source == page_id and target in ids:
                cells.append((row, size + ids[target]))
        cells += [(row, 2 * size + category_ids[c]) for i, c in CATEGORIES if i == page_id and c in category_ids]
    return Counter(cells)


def test_matrix_by_definition(spark, tables, monkeypatch):
    names = make_dictionaries(*tables, threshold=4)
    kept = expected_kept(4)
    pages = [r["name"] for r in names.pages.orderBy("id").collect()]
    categories = [r["name"] for r in names.categories.orderBy("id").collect()]
    assert pages == [title for _, title in kept] and pages.count("A") == 2
    assert categories == sorted({c for i, c in CATEGORIES if i in dict(kept)})
    assert (names.shape().rows, names.shape().cols) == (len(pages), 2 * len(pages) + len(categories))
    want = expected_cells(pages, categories)

    def cells():
        df = op.build_cells(*tables, names.pages, names.categories)
        assert {r["value"] for r in df.collect()} == {1.0}
        return Counter((r["row"], r["col"]) for r in df.collect())

    assert cells() == want
    real = lookup.lookup_join
    monkeypatch.setattr(op, "lookup_join", lambda *a, **k: real(*a, **{**k, "broadcast_bytes": 0, "hot_rows": 2}))
    assert cells() == want


def test_duplicate_names_map_to_their_last_id(spark):
    dictionary = written(spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "id long, name string"), "d")
    names = spark.createDataFrame([("a",), ("b",), ("?",)], "name string")
    got = {r["name"]: r["id"] for r in op.lookup_id(names, dictionary).collect()}
    assert got == {"a": 2, "b": 1, "?": -1}


def test_category_pages(spark, tables):
    page, links, categories = tables
    assert [r[0] for r in op.category_pages(op.kept_pages(page, links, 1), categories).collect()] == ["A"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(spark, how):
    # A third of the rows share one key, some of them are copies, some keys are missing or unknown.
    facts = written(
        spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
                F.concat(F.lit("k"), F.col("id") % 200)
            ).alias("key"),
            (F.col("id") % 10).alias("x"),
            F.col("id").alias("_row"),
        ),
        "facts",
    )
    table = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(100)], "key string, y long")
    table = written(table, "lookup")
    sliced = lookup_join(facts, table, ["key"], how, ["_row"], broadcast_bytes=0, hot_rows=100)
    plain = facts.join(table, "key", how)
    assert sorted(map(str, sliced.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    if how in ("inner", "left"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df = lookup_join(facts, table, ["key"], how, ["_row"], broadcast_bytes=0, hot_rows=100)
            sizes = df.groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert max(r["count"] for r in sizes) < df.count() / 2


def test_every_frequent_key_is_found(spark):
    facts = spark.range(1000).select(F.floor(F.sqrt("id")).alias("k"))
    counts = Counter(int(i**0.5) for i in range(1000))
    got = {r["k"]: r["_rows"] for r in frequent_keys(facts, ["k"], 10).collect()}
    assert got == {k: n for k, n in counts.items() if n > 10}


def test_stored_bytes_counts_strings_and_arrays(spark):
    df = spark.createDataFrame([("x" * 100, [1.0] * 50), (None, None)], "s string, a array<double>")
    assert stored_bytes(df) >= 100 + 400 and stored_bytes(df.limit(0)) == 0


def test_dense_ids(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    rows = dense_ids(df, "name").orderBy("id").collect()
    names = [r["name"] for r in rows]
    assert [r["id"] for r in rows] == list(range(5000)) and names == sorted(names)


def test_positions_of_copies(spark):
    df = written(spark.range(3000).select((F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id"))).alias("v")), "v")
    rows = with_positions(df, "v", copies=True).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(3000))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)


def test_unstored_facts_are_computed_once_in_a_join_by_key(spark, tmp_path):
    """Above the broadcast size, facts that come from a parse are written before their keys are counted."""
    from linkloom.operators import dumps
    from linkloom.sources import lines as source

    text = "\n".join(f"INSERT INTO `t` VALUES ({i % 7},0,'T{i % 3}');" for i in range(300))
    (tmp_path / "d.sql").write_text(text)
    tuples = dumps.parse_dump_tuples(source.read_lines(spark, str(tmp_path / "d.sql")))
    titles = written(spark.createDataFrame([("T0",), ("T1",)], "page_title string"), "titles")
    ids = written(spark.createDataFrame([(1,), (2,)], "id long"), "ids")
    limits = {"broadcast_bytes": 1, "hot_rows": 20}
    for kept, rows in ((dumps.semi_by_title(tuples, titles, **limits), 200), (dumps.semi_by_id(tuples, ids, **limits), 86)):
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan and kept.count() == rows
