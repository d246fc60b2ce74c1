"""Mixing against SQL, and the bounds that Pfair schedules keep."""

import pytest
from brute import edf
from compare import checker, compare
from conftest import DATA

from linkloom.llm.common import columns
from linkloom.llm import mixing as op
from linkloom.llm.queries import ORACLES, QUERIES


def test_query_against_sql(spark):
    name = "op3_mixing"
    count, _, plan = compare(spark, name, QUERIES[name], ORACLES[name], DATA, checker(DATA))
    assert count == 200 and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [19, 1, 1, 1], [*op.WEIGHTS.values(), op.REST], [7] * 9 + [1]])
def test_schedule_of_a_frame(weights):
    frame = op.frame_schedule(weights)
    assert [f[:2] for f in frame] == edf(weights)
    slots = sum(weights)
    done = [0] * len(weights)
    for source, block, slot, release, deadline in frame:
        assert release <= slot < deadline and block == done[source]
        done[source] += 1
        for i, a in enumerate(weights):
            assert abs(done[i] - (slot + 1) * a / slots) < 1


def test_less_than_a_block_off_while_all_sources_last(spark, tmp_path):
    docs = [(i, "ab"[i % 2] if i % 5 else None) for i in range(3000)]
    spark.createDataFrame(docs, "doc_id bigint, source string").write.parquet(f"{tmp_path}/docs")
    mixed = op.mix(spark.read.parquet(f"{tmp_path}/docs"), {"a": 5, "b": 3}, rest=2, block_rows=10)
    rows = sorted(mixed.collect(), key=lambda r: (r["slot"], r["place"]))
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    assert len({(r["slot"], r["place"]) for r in rows}) == 3000
    seen = {"a": 0, "b": 0, None: 0}
    for n, r in enumerate(rows[:2000], 1):
        seen[r["source"]] += 1
        for source, share in (("a", 0.5), ("b", 0.3), (None, 0.2)):
            assert abs(seen[source] - n * share) < 2 * 10
        assert r["release"] <= r["slot"] < r["deadline"]


def test_every_source_of_the_documents_keeps_its_weight(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source")
    assert {r["source"] for r in docs.select("source").distinct().collect()} <= {*op.WEIGHTS, None}
    rows = sorted(op.mix(docs, op.WEIGHTS, op.REST).collect(), key=lambda r: (r["slot"], r["place"]))
    total, blocks, ends = sum(op.WEIGHTS.values()) + op.REST, {}, {}
    for r in rows:
        ends[r["source"]] = max(ends.get(r["source"], 0), r["slot"])
        blocks.setdefault(r["source"], set()).add(r["slot"])
    for source, weight in op.WEIGHTS.items():
        taken = sorted(blocks[source])
        # Less than one block off, after each of its blocks and as long as it lasts.
        assert all(abs(n - (slot + 1) * weight / total) < 1 for n, slot in enumerate(taken, 1)), source
        assert all(abs(n - slot * weight / total) < 1 for n, slot in enumerate(taken)), source


def test_awkward(spark, awkward, nothing):
    got = op.mixing_stage(spark, awkward, DATA)
    assert got.columns[: len(awkward.columns)] == awkward.columns and len(got.columns) == len(awkward.columns) + 2
    assert sorted(map(str, got.select(*columns(awkward)).collect())) == sorted(map(str, awkward.collect()))
    places = [tuple(r) for r in got.select(*columns(got)[-2:]).collect()]
    assert len(set(places)) == len(places) and places == sorted(places)
    assert op.mixing_stage(spark, nothing, DATA).count() == 0


def test_weights_are_checked(documents):
    with pytest.raises(ValueError):
        op.mix(documents, {"src0": 0}, 1)
