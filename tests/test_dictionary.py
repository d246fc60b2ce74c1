"""Front-coded dictionaries: every name comes back and is found, nothing else is."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions.front_coding import PART_NAMES, Dictionary, encode_part
from linkloom.operators import dictionary as op
from linkloom.operators.links import in_dictionary, lookup_id
from linkloom.operators.lookup import stored_bytes
from linkloom.runtime import written


def hashes(names, bits=64):
    return np.array([int.from_bytes(hashlib.blake2b(n, digest_size=8).digest(), "little") >> (64 - bits) for n in names], dtype=np.uint64)


def build(names, size, bits=64):
    names = sorted(set(names))
    parts = [names[i : i + size] for i in range(0, len(names), size)]
    return names, Dictionary([encode_part(p, hashes(p, bits), 7 * np.arange(i * size, i * size + len(p))) for i, p in enumerate(parts)])


# Few letters and long repeats, so that names share prefixes, end in zero bytes and are prefixes of each other.
NAMES = st.lists(st.one_of(st.binary(max_size=4), st.text("ab\0", max_size=12).map(str.encode), st.integers(0, 300).map(lambda n: b"ab" * n)), max_size=80)


@settings(max_examples=150, deadline=None)
@given(NAMES, NAMES, st.integers(1, 40), st.sampled_from([64, 64, 5]))
def test_found_as_in_a_dict(names, others, size, bits):
    """With hashes of five bits many names cannot be told apart and are kept whole."""
    names, coded = build(names, size, bits)
    ids = {n: 7 * i for i, n in enumerate(names)}
    sought = [*names, *others, *(n[:-1] for n in names), *(n + b"a" for n in names)]
    assert coded.find(sought, hashes(sought, bits)).tolist() == [ids.get(n, -1) for n in sought]
    assert [n for p in range(len(coded.firsts)) for n in coded.names(p)] == names


def test_unknown_names_with_the_hash_of_a_known_one():
    names, coded = build([f"name {i}".encode() for i in range(500)], 200)
    wrong = [n + b"?" for n in names]
    assert (coded.find(wrong, hashes(names)) == -1).all()


@pytest.fixture(scope="module")
def titles(spark):
    rows = spark.range(150_000).select(F.concat(F.lit("List of pages about subject number "), F.col("id") * 37 % 150_000).alias("name"), "id")
    return written(rows, "titles")


def test_size_and_round_trip(titles):
    compact = op.compact_dictionary(titles)
    assert compact.names == 150_000 and compact.parts.count() == -(-150_000 // PART_NAMES)
    # 41 bytes of name, 8 of id and what a row takes, against less than a name.
    assert compact.bytes_per_name < 25 < stored_bytes(titles) / 150_000 / 4
    assert op.decoded(compact).exceptAll(titles.select("id", "name")).isEmpty()
    loaded = Dictionary(op._parts(compact.parts.toArrow().to_pylist()))
    assert loaded.stored() / compact.names < 20


def test_lookup_equals_join(spark, titles):
    ids = spark.range(40_000)
    names = ids.select(F.concat(F.lit("List of pages about subject number "), F.col("id") * 5).alias("name"), "id").drop("id")
    facts = written(names.union(names.limit(100)).union(spark.createDataFrame([(None,), ("",), ("List",)], "name string")), "facts")
    by_table, by_key = lookup_id(facts, titles), op.with_ids(facts, titles, "name", ["name"], 0, 0)
    compact = lookup_id(facts, titles, broadcast_bytes=0)
    plan = compact._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Exchange" not in plan
    assert compact.columns == by_table.columns == by_key.columns
    assert compact.exceptAll(by_table).isEmpty() and by_table.exceptAll(compact).isEmpty()
    assert compact.exceptAll(by_key).isEmpty() and by_key.exceptAll(compact).isEmpty()
    assert compact.where("id = -1").count() == 40_000 - 30_000 + 3


def test_repeated_names_other_columns_and_bytes(spark):
    known = spark.createDataFrame([(0, bytearray(b"a\xff")), (1, bytearray(b"b")), (2, bytearray(b"b")), (3, None)], "id bigint, name binary")
    known = written(known.withColumn("name", F.col("name").cast("string")), "known")
    page = spark.createDataFrame([(10, bytearray(b"a\xff")), (11, bytearray(b"a\xfe")), (12, bytearray(b"b")), (13, None)], "page_id bigint, page_title binary")
    page = written(page.withColumn("page_title", F.col("page_title").cast("string")), "page")
    got = in_dictionary(page, known, broadcast_bytes=0).select("page_id", F.col("page_title").cast("binary").alias("t"), "id").collect()
    assert {(r["page_id"], bytes(r["t"]), r["id"]) for r in got} == {(10, b"a\xff", 0), (12, b"b", 2)}


def test_empty_sides(spark, titles):
    none = written(titles.where("false"), "none")
    assert op.find_ids(titles.select("name").limit(3), op.compact_dictionary(none), "name").select("id").collect() == [(-1,)] * 3
    assert lookup_id(none.select("name"), titles, broadcast_bytes=0).count() == 0
