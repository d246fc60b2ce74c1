import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import checker, compare
from conftest import DATA
from pyspark.sql import functions as F

from linkloom.llm import prefix_trie as p
from linkloom.llm.queries import ORACLES, QUERIES

KINDS = "conv_id bigint, turn bigint, role string, text string"


def rebuilt_by_hand(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(role, text) for _, _, role, _, text in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(conversations: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    out = set()
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        size = len(key[-1][1].encode()) if key else 0
        leaves, saved = int(not children[key]), (len(members[key]) - 1) * size
        for child in children[key]:
            leaves, saved = leaves + sums[child][0], saved + sums[child][1]
        sums[key] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[key]) if len(conversations[c]) == len(key))
        out.add((
            min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(children[key]),
            leaves, saved, hashlib.sha256(ends.encode()).hexdigest(), size,
        ))
    return out


def made(seed: int, convs: int, most: int, words: int = 2) -> list[tuple]:
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "assistant"]), draw.choice([f"é{draw.randrange(words)}", "same"]))
        for c in draw.sample(range(-20, 400), convs)
        for t in range(draw.randrange(1, most))
    ]


def found(spark, rows, tmp_path, **options):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, KINDS).write.parquet(path)
    turns = p.numbered_turns(spark.read.parquet(path))
    rows = p.prefix_trie(p.shared_starts(turns), turns.select("conv_id"), **options).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("task_nodes", [1, 7, 20_000])
def test_equals_brute_force(spark, tmp_path, task_nodes):
    rows = made(1, 60, 12)
    assert found(spark, rows, tmp_path, task_nodes=task_nodes) == brute(rebuilt_by_hand(rows))


def test_long_path_and_runs_of_turns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(p, "RUN_ROWS", 16)
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(260)] + [(10, t, "user", f"turn {t % 7}") for t in range(200)]
    rows += [(20 + 5 * c, t, "user", "all alike") for c in range(60) for t in range(3)]
    assert found(spark, rows, tmp_path, task_nodes=40) == brute(rebuilt_by_hand(rows))


def test_awkward_rows(spark, tmp_path):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, None, None), (1, None, "user", None), (1, 2, "user", "x" * 100_000), (1, 2, "user", "tie"),
        (1, 2, "user", "tie"), (2, 1, "user", ""), (-3, 1, "user", "ü"), (-3, 0, "", ""), (5, 7, "", ""), (6, 1, "user", "short"), (6, 1, None, None),
    ]
    assert found(spark, rows, tmp_path, task_nodes=2) == brute(rebuilt_by_hand(rows))


def test_clashing_names_and_nothing(spark, tmp_path):
    rows = made(2, 10, 5)
    path = str(tmp_path / "extra.parquet")
    names = ("place", "depth", "node", "left", "run", "at", "first", "digest", "meta.origin", "a`b")
    spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("own") for c in names}).write.parquet(path)
    turns = p.numbered_turns(spark.read.parquet(path))
    result = p.prefix_trie(p.shared_starts(turns), turns.select("conv_id"))
    assert {tuple(r) for r in result.collect()} == brute(rebuilt_by_hand(rows))
    empty = p.numbered_turns(spark.read.parquet(path).limit(0))
    none = p.prefix_trie(p.shared_starts(empty), empty.select("conv_id"))
    assert none.collect() == [] and none.columns == result.columns


def test_split_in_task_on_shapes():
    draw = random.Random(4)
    shapes = {
        "path": [i - 1 for i in range(200)],
        "star": [-1] + [0] * 199,
        "forest": [-1 if draw.random() < 0.1 else draw.randrange(i) for i in range(1, 200)],
    }
    shapes["forest"] = [-1, *shapes["forest"]]
    for parent in shapes.values():
        value = [draw.randrange(100) for _ in parent]
        size, expected = [1] * len(parent), list(value)
        for v in range(len(parent) - 1, -1, -1):
            if parent[v] >= 0:
                size[parent[v]] += size[v]
                expected[parent[v]] += expected[v]
        assert p.split_in_task(parent, size, [value]) == [expected]


def test_query_against_sql(spark):
    count, _, _ = compare(spark, "op11_prefix_trie", QUERIES["op11_prefix_trie"], ORACLES["op11_prefix_trie"], DATA, checker(DATA))
    assert count > 20  # all nodes of the smallest table; their values equal those of the SQL
