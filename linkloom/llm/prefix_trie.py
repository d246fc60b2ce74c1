"""Prefix trie of conversations, with sums over subtrees by centroid decomposition.

A node is a sequence of turns with which at least one conversation begins; the root is the empty one. Its members are
the conversations that begin with it. Node ``(conv_id, depth)`` is named by its smallest member; below the depth at which
a conversation is first the smallest, it names every node it goes through, so names are unique.

Sums over the subtree of every node come from a centroid decomposition of the forest of parent edges:

1. In each component the centroid is the deepest node that holds more than half of the weight, the turns of
   conversations that pass below it, which are counted with the nodes and need no recursion.
2. The totals of the centroid and of the components below it are added to each node on the path from the
   centroid up to the top of the component. Which nodes these are, the centroid's own turns tell.
3. Without the centroid the component falls into the components below it and the rest above, of at most half the weight
   each, in which the same is done.

Components of more than ``TASK_NODES`` nodes are split by joins, all of them at once in each round; the others are split to the end
inside tasks, many small ones together. A path of a million turns takes as few rounds as a bushy tree.

A prefix is known by the exclusive or of 120-bit hashes of its turns with their places, so no turn is compared with
another and a conversation of any length is cut into runs of turns that tasks go through apart.

Defined results: null roles and texts count as empty. Turns come in the order of ``turn``, null first, those of equal ``turn`` by role
and then by a hash of their text; equal ones are as many turns. Rows without ``conv_id`` belong to no conversation and
are left out. A conversation without turns ends at the root. An empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.catalog.oracle import crc32
from linkloom.llm.common import attach, ship_package, table, written
from linkloom.operators.positions import with_positions

# Components of more nodes than this are split by joins, smaller ones inside tasks.
TASK_NODES = 20_000
# Turns of a conversation, and members that end at a node, which one group holds.
RUN_ROWS = 4_096
_HALF = 15  # hexadecimal digits of half a hash: 60 bits

# First turns that conversations of a group may share are fewer than this.
LARGEST_SHARED = 9


def turn_hash(role: Column, text: Column, place: Column) -> tuple[Column, Column]:
    """Both halves of the hash of a turn at its place; lengths keep role and text apart."""
    digest = F.md5(F.concat_ws(":", place.cast("string"), F.octet_length(role).cast("string"), F.concat(role, text)))
    return tuple(F.conv(F.substring(digest, 1 + i * _HALF, _HALF), 16, 10).cast("bigint") for i in (0, 1))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, role, text_bytes, digest``, written: turns numbered from 0 in each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.octet_length(text).cast("bigint").alias("text_bytes"), F.md5(text.cast("binary")).alias("digest"),
    )
    rows = written(rows, "turns")
    placed = written(with_positions(rows, F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), name="at", copies=True), "placed-turns")
    first = written(placed.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("_rows")), "first-turns")
    hot = first.where(F.col("_rows") > RUN_ROWS).select("conv_id", "_rows")
    placed = attach(placed, first.select("conv_id", "first"), ["conv_id"], spread_by=["at"], hot=hot, hot_rows=RUN_ROWS)
    return written(placed.select("conv_id", (F.col("at") - F.col("first")).alias("place"), "role", "text_bytes", "digest"), "numbered-turns")


def shared_starts(turns: DataFrame, group: int = 5, most: int = LARGEST_SHARED) -> DataFrame:
    """``turns`` with conversations that begin like the first of their group.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % group``, as many as there are, and goes on with its own turns after its
    first ``h``; ``h`` is the CRC-32 of ``c`` modulo ``most``.
    """
    own = F.col("conv_id")
    shared = (F.crc32(own.cast("string").cast("binary")) % most).alias("shared")
    convs = written(turns.select("conv_id").distinct().select("conv_id", shared, (own - own % group).alias("base")), "conversations")
    heads = written(turns.where(F.col("place") < most - 1).withColumnRenamed("conv_id", "base"), "heads")
    # At most 2 * group conversations have a base, and a base has fewer than ``most`` heads.
    taken = convs.join(heads, "base").where(F.col("place") < F.col("shared")).select(*turns.columns)
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    there = F.least(F.coalesce("there", F.lit(0)), F.col("shared"))
    kept = convs.join(lengths, "base", "left").select("conv_id", "shared", there.cast("bigint").alias("there"))
    rest = attach(turns, written(kept, "shared-lengths"), ["conv_id"], spread_by=["place"], hot_rows=RUN_ROWS)
    rest = rest.where(F.col("place") >= F.col("shared")).withColumn("place", F.col("place") - F.col("shared") + F.col("there"))
    return written(taken.unionByName(rest.select(*turns.columns)), "rebuilt-turns")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, left, right, text_bytes``, written: the hash of each prefix of each conversation with turns.

    The running exclusive or goes over runs of turns; the totals of runs are carried on between them.
    """
    one, two = turn_hash(F.col("role"), F.col("digest"), F.col("place"))
    rows = turns.select("conv_id", "place", "text_bytes", one.alias("one"), two.alias("two"))
    run = F.expr(f"place div {RUN_ROWS}").alias("run")
    rows = rows.select("*", run)
    here = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "run", "place", "text_bytes", *[F.bit_xor(c).over(here).alias(c) for c in ("one", "two")])
    rows = written(rows, "runs")
    # One row per run of turns that is full: none for a conversation of usual length.
    totals = rows.where(F.col("place") == (F.col("run") + 1) * RUN_ROWS - 1).select("conv_id", (F.col("run") + 1).alias("run"), "one", "two")
    sofar = Window.partitionBy("conv_id").orderBy("run")
    carried = totals.select("conv_id", "run", *[F.bit_xor(c).over(sofar).alias(f"{c}_before") for c in ("one", "two")])
    rows = attach(rows, written(carried, "carried"), ["conv_id", "run"], "left", spread_by=["place"])
    halves = [F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0))).alias(n) for c, n in (("one", "left"), ("two", "right"))]
    return written(rows.select("conv_id", (F.col("place") + 1).alias("depth"), *halves, "text_bytes"), "prefixes")


def nodes_and_steps(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, the nodes that named conversations go through, and the node at which each conversation ends, all written.

    ``conv_id, depth, n_convs, weight, text_bytes``; ``conv_id, depth, node``; ``conv_id, depth, node``. ``conversations(conv_id)``
    may hold some without turns.
    """
    rows = prefixes(turns)
    lengths = rows.groupBy("conv_id").agg(F.max("depth").alias("length"))
    lengths = written(lengths, "lengths")
    hot = lengths.where(F.col("length") > RUN_ROWS).select("conv_id", F.col("length").alias("_rows"))
    rows = written(attach(rows, lengths, ["conv_id"], spread_by=["depth"], hot=hot, hot_rows=RUN_ROWS), "measured-prefixes")
    found = rows.groupBy("depth", "left", "right").agg(
        F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.first("text_bytes").alias("text_bytes"),
    )
    found = written(found, "found-nodes")
    hot = found.where(F.col("n_convs") > RUN_ROWS).select("depth", "left", "right", F.col("n_convs").alias("_rows"))
    keys = ["depth", "left", "right"]
    through = attach(rows, found.select(*keys, "node"), keys, spread_by=["conv_id"], hot=hot, hot_rows=RUN_ROWS)
    through = written(through.select("conv_id", "depth", "node", (F.col("depth") == F.col("length")).alias("last")), "through")
    named = written(found.select(F.col("node").alias("conv_id")).distinct(), "named")
    steps = attach(through, named, ["conv_id"], "left_semi", spread_by=["depth"], hot_rows=RUN_ROWS)

    everyone = written(conversations.select("conv_id").distinct(), "everyone")
    count, smallest = everyone.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    below = lengths.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    zero = F.lit(0).cast("bigint")
    long = [F.lit(x).cast("bigint") for x in (smallest, count, count + below)]
    root = everyone.where(F.col("conv_id") == long[0])  # one row, or none of an empty table
    top = root.select("conv_id", zero.alias("depth"), long[1].alias("n_convs"), long[2].alias("weight"), zero.alias("text_bytes"))
    nodes = found.select(F.col("node").alias("conv_id"), "depth", "n_convs", "weight", "text_bytes").unionByName(top)
    starts = named.unionByName(root).distinct().select("conv_id", zero.alias("depth"), long[0].alias("node"))
    steps = steps.select("conv_id", "depth", "node").unionByName(starts)
    turnless = attach(everyone, lengths.select("conv_id"), ["conv_id"], "left_anti", spread_by=["conv_id"])
    ends = through.where("last").select("conv_id", "depth", "node")
    ends = ends.unionByName(turnless.select("conv_id", zero.alias("depth"), long[0].alias("node")))
    return written(nodes, "nodes"), written(steps, "steps"), written(ends, "ends")


def split_in_task(parent: list[int], size: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums over subtrees of a forest by centroid decomposition; parents come before children, -1 is none.

    ``size`` holds the nodes of each subtree and is used up.
    """
    n = len(parent)
    children: list[list[int]] = [[] for _ in range(n)]
    for v, p in enumerate(parent):
        if p >= 0:
            children[p].append(v)
    gone = bytearray(n)
    sums = [[0] * n for _ in values]
    tops = [v for v, p in enumerate(parent) if p < 0]
    while tops:
        top = tops.pop()
        half, centroid = size[top], top
        while True:
            heavy = next((c for c in children[centroid] if not gone[c] and 2 * size[c] > half), -1)
            if heavy < 0:
                break
            centroid = heavy
        gone[centroid] = 1
        below = [c for c in children[centroid] if not gone[c]]
        # The centroid and the components below it.
        part, left = [centroid], list(below)
        while left:
            v = left.pop()
            part.append(v)
            left += [c for c in children[v] if not gone[c]]
        totals = [sum(map(value.__getitem__, part)) for value in values]
        v, taken = centroid, size[centroid]
        while True:
            for total, out in zip(totals, sums, strict=True):
                out[v] += total
            size[v] -= taken
            if v == top:
                break
            v = parent[v]
        tops += below
        if centroid != top:
            tops.append(top)
    return sums


def subtree_sums(nodes: DataFrame, steps: DataFrame, values: list[str], task_nodes: int = TASK_NODES) -> DataFrame:
    """``conv_id, depth, *values``, written: the values of each node summed over its subtree.

    ``nodes(conv_id, depth, weight, *values)`` where the weight of a node covers its subtree; ``steps(conv_id, depth, node)`` holds
    the nodes that each conversation which names one goes through.
    """
    # A component is named by its top: all nodes are in that of the root, the smallest conversation of all.
    smallest = nodes.agg(F.min("conv_id")).first()[0]
    name = ["top_conv", "top_depth"]
    start = [F.lit(x).cast("bigint").alias(c) for x, c in zip((smallest, 0), name, strict=True)]
    state = nodes.select("conv_id", "depth", "weight", *values, *start)
    # Each step with the one after it.
    after = steps.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("node").alias("below"))
    turns = steps.join(after, ["conv_id", "depth"], "left").withColumnsRenamed({"depth": "c_depth", "node": "at_centroid"})
    turns = written(turns, "step-pairs")
    found: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        state = written(state, "components")
        sizes = state.groupBy(*name).agg(F.count(F.lit(1)).alias("nodes"), F.max("weight").alias("whole"))
        large = written(sizes.where(F.col("nodes") > task_nodes), "large-components")
        hot = large.select(*name, F.col("nodes").alias("_rows"))
        small.append(attach(state, large.select(*name), name, "left_anti", spread_by=["conv_id", "depth"], hot=hot))
        if large.isEmpty():
            break
        inside = written(attach(state, large.select(*name, "whole"), name, spread_by=["conv_id", "depth"], hot=hot), "large-nodes")
        # The nodes with more than half of the weight lie on one path; the centroid is its end.
        heavy = inside.where(2 * F.col("weight") > F.col("whole"))
        centroids = heavy.groupBy(*name).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
        centroids = centroids.select(*name, *[F.col(f"c.{a}").alias(b) for a, b in (("conv_id", "c_conv"), ("depth", "c_depth"), ("weight", "c_weight"))])
        centroids = written(centroids, "centroids")
        inside = written(attach(inside, centroids, name, spread_by=["conv_id", "depth"], hot=hot), "centred-nodes")
        # Where a node's own turns pass at the centroid's depth and the one below tells on which side it lies.
        inside = attach(inside, turns, ["conv_id", "c_depth"], "left", spread_by=["depth"], hot_rows=RUN_ROWS)
        # A step deeper than the node itself says nothing about it.
        under_centroid = (F.col("depth") >= F.col("c_depth")) & (F.col("at_centroid") == F.col("c_conv"))
        side = F.when(~F.coalesce(under_centroid, F.lit(False)), "above").when(F.col("depth") > F.col("c_depth"), "below")
        inside = written(inside.withColumn("side", side.otherwise("centroid")), "sides")
        totals = inside.where("side != 'above'").groupBy(*name).agg(*[F.sum(v).alias(v) for v in values])
        ends = written(centroids.join(totals, name), "centroid-totals")
        paths = attach(steps.withColumnRenamed("conv_id", "c_conv"), ends, ["c_conv"], spread_by=["depth"], hot_rows=RUN_ROWS)
        paths = paths.where((F.col("depth") >= F.col("top_depth")) & (F.col("depth") <= F.col("c_depth")))
        paths = written(paths.select(F.col("node").alias("conv_id"), "depth", *name, "c_weight", *values), "paths")
        found.append(paths.select("conv_id", "depth", *values))
        # What is above the centroid keeps its top and loses the centroid's weight on the path; what is below has new tops.
        above = inside.where("side = 'above'").drop("c_weight")
        above = above.join(paths.select("conv_id", "depth", *name, "c_weight"), ["conv_id", "depth", *name], "left")
        above = above.withColumn("weight", F.col("weight") - F.coalesce("c_weight", F.lit(0)))
        below = inside.where("side = 'below'").withColumns({"top_conv": F.col("below"), "top_depth": F.col("c_depth") + 1})
        columns = ["conv_id", "depth", "weight", *values, *name]
        state = above.select(*columns).unionByName(below.select(*columns))
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    found.append(_small_sums(written(rest, "small-components"), steps, values, task_nodes))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return written(whole.groupBy("conv_id", "depth").agg(*[F.sum(v).alias(v) for v in values]), "subtree-sums")


def _small_sums(state: DataFrame, steps: DataFrame, values: list[str], task_nodes: int) -> DataFrame:
    """``conv_id, depth, *values``: sums within components of at most ``task_nodes`` nodes, many in a group."""
    parents = steps.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    rows = state.join(parents, ["conv_id", "depth"], "left")
    groups = 1 + state.count() // task_nodes
    rows = rows.withColumn("group", F.pmod(F.xxhash64("top_conv", "top_depth"), F.lit(groups)))

    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["depth", "conv_id"], ignore_index=True)
        names = list(zip(group["conv_id"], group["depth"], strict=True))
        index = {name: i for i, name in enumerate(names)}
        is_top = (group["conv_id"] == group["top_conv"]) & (group["depth"] == group["top_depth"])
        parent = [-1 if top else index[int(p), d - 1] for (_, d), p, top in zip(names, group["parent"], is_top, strict=True)]
        size = [1] * len(names)
        for v in range(len(names) - 1, -1, -1):
            if parent[v] >= 0:
                size[parent[v]] += size[v]
        sums = split_in_task(parent, size, [group[v].tolist() for v in values])
        return pd.DataFrame({"conv_id": group["conv_id"], "depth": group["depth"], **dict(zip(values, sums, strict=True))})

    kinds = ", ".join(["conv_id bigint", "depth bigint", *[f"{v} bigint" for v in values]])
    wanted = rows.select("conv_id", "depth", "parent", "top_conv", "top_depth", "group", *values)
    return written(wanted.groupBy("group").applyInPandas(split, kinds), "task-sums")


def end_hashes(ends: DataFrame) -> DataFrame:
    """``node, depth, ends_sha256``, written: the hash of the ids that end at each node, in numerical order and joined by commas.

    Ids are joined in runs; a hash over several runs is carried on from one to the next, with one run in memory.
    """
    rows = with_positions(ends.select("conv_id", "depth", "node"), F.col("depth"), F.col("node"), F.col("conv_id"), name="at")
    runs = rows.groupBy("depth", "node", F.expr(f"at div {RUN_ROWS}").alias("run")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids")
    )
    runs = written(runs, "end-runs")
    several = runs.groupBy("depth", "node").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1").select("depth", "node")
    several = written(several, "long-ends")
    whole = attach(runs, several, ["depth", "node"], "left_anti", spread_by=["run"]).select("node", "depth", F.sha2("ids", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids")), strict=True):
                if (node, depth) != at:
                    if at is not None:
                        yield _digest_row(at, state)
                    at, state = (node, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if at is not None:
            yield _digest_row(at, state)

    parts = attach(runs, several, ["depth", "node"], "left_semi", spread_by=["run"])
    parts = parts.repartition("depth", "node").sortWithinPartitions("depth", "node", "run").select("node", "depth", "ids")
    return written(whole.unionByName(parts.mapInArrow(digest, "node bigint, depth bigint, ends_sha256 string")), "end-hashes")


def _digest_row(at: tuple[int, int], state) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"node": pa.array([at[0]], pa.int64()), "depth": pa.array([at[1]], pa.int64()), "ends_sha256": [state.hexdigest()]})


def prefix_trie(turns: DataFrame, conversations: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, text_bytes``.

    ``turns`` as :func:`numbered_turns` returns them, written; ``conversations(conv_id)`` all of them, with or without turns.
    """
    ship_package(turns.sparkSession)
    nodes, steps, ends = nodes_and_steps(turns, conversations)
    key = ["conv_id", "depth"]
    parents = steps.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = written(nodes.join(parents, key, "left"), "named-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = written(children.agg(F.count(F.lit(1)).alias("n_children")), "children")
    nodes = written(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "whole-nodes")
    valued = nodes.select(
        *key, "weight", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("text_bytes")).alias("saved_tokens"),
    )
    sums = subtree_sums(valued, steps, ["n_leaves", "saved_tokens"], task_nodes)
    hashes = end_hashes(ends).withColumnRenamed("node", "conv_id")
    rows = nodes.join(sums, key).join(hashes, key, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return rows.select(
        *key, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"), "text_bytes",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations, each of which begins like the first of its group of five."""
    turns = numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(shared_starts(turns), turns.select("conv_id"))


OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), lengths AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, ({crc32("conv_id::VARCHAR")}) % {LARGEST_SHARED} AS h FROM lengths
), rebuilt AS (
  SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.place < c.h
  UNION ALL
  SELECT o.conv_id, o.place - c.h + least(c.h, coalesce(l.n, 0)), o.role, o.text
  FROM own o JOIN convs c USING (conv_id) LEFT JOIN lengths l ON l.conv_id = c.base WHERE o.place >= c.h
), whole AS (
  SELECT c.conv_id, coalesce(s.turns, []) AS turns
  FROM convs c LEFT JOIN (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY place) AS turns FROM rebuilt GROUP BY conv_id
  ) s USING (conv_id)
), members AS (
  SELECT conv_id, depth, turns[1:depth] AS key, len(turns) = depth AS at_end
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM whole)
), nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(key[depth].text)) END AS text_bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256
  FROM members GROUP BY key, depth
), children AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
valued AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (key)),
sums AS (
  SELECT key[1:above] AS key, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * text_bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM valued) GROUP BY ALL
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256,
  v.text_bytes::BIGINT AS text_bytes
FROM valued v JOIN sums s USING (key) LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.key = v.key[1:v.depth - 1]
"""
