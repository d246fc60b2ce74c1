"""Mixing sources to target weights by Pfair scheduling.

A frame has as many slots as all weights together, and a source of weight ``a`` gets ``a`` of its
blocks into each frame of ``M`` slots. Block ``j`` of the source is released at slot ``floor(j M / a)``
and due by slot ``ceil((j + 1) M / a)``. Of the released blocks the one with the earliest deadline
goes first. As the weights fill the frame exactly, every deadline is met and no source is ever a whole
block ahead of or behind its share. The schedule of a frame depends on the weights alone and repeats, so a
block finds its slot by arithmetic on its number.

Nothing is dropped or repeated: when a source has run out its slots stay empty, and the others keep
their proportions. All work is DataFrame expressions: one range sort for the place of a row in
its source, joins with one row per frame slot and per source.

Defined results: sources that the weights do not name, null included, share one weight as one source.
Within a source rows are in the order of a hash of their id, so that neighbours are mixed; equal
ids, repeated rows and null ids stand side by side in any order. An empty table gives an empty
result. Other columns are kept by the stage and ignored by the query.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import columns, fresh, packed, table
from linkloom.operators.positions import with_positions

# Slots of each source in a frame, and of rows without a source or of one not named here.
WEIGHTS = {
    "src0": 10, "src1": 8, "src2": 8, "src3": 8, "src4": 8,
    "src5": 6, "src6": 6, "src7": 6, "src8": 6, "src9": 6,
    "src10": 3, "src11": 3, "src12": 3, "src13": 3, "src14": 3,
    "src15": 2, "src16": 2, "src17": 2, "src18": 2, "src19": 2,
}
REST = 3
BLOCK_ROWS = 16


def frame_schedule(weights: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(source, block, slot, release, deadline)`` of one frame by earliest deadline first; ties go to the first source."""
    slots = sum(weights)
    waiting = sorted((j * slots // a, -(-(j + 1) * slots // a), i, j) for i, a in enumerate(weights) for j in range(a))
    ready: list[tuple[int, int, int, int]] = []
    out, taken = [], 0
    for slot in range(slots):
        while taken < slots and waiting[taken][0] <= slot:
            release, deadline, source, block = waiting[taken]
            heapq.heappush(ready, (deadline, source, block, release))
            taken += 1
        deadline, source, block, release = heapq.heappop(ready)
        out.append((source, block, slot, release, deadline))
    return out


def mix(
    docs: DataFrame, weights: dict[str, int], rest: int, block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id", source_col: str = "source", prefix: str = "",
) -> DataFrame:
    """``docs`` with ``slot``, ``place`` in the slot, and ``block``, ``release`` and ``deadline`` of its source.

    The mixture is the order of (slot, place). ``docs`` should be a file or written table. The names
    of the new columns begin with ``prefix``.
    """
    if rest < 1 or block_rows < 1 or min(weights.values(), default=1) < 1:
        raise ValueError("weights and block_rows must be positive")
    names, shares = list(weights), [*weights.values(), rest]
    slots = sum(shares)
    number = F.lit(len(names))
    for i, name in enumerate(names):
        number = F.when(F.col(source_col) == name, i).otherwise(number)
    order = F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 16)
    rows = packed(docs, number.alias("number"), order.alias("hash"), F.col(id_col).alias("id"))
    rows = with_positions(rows, "number", "hash", "id", name="position", copies=True).drop("hash", "id")
    # One row per named source, and one row per slot of a frame.
    starts = rows.groupBy("number").agg(F.min("position").alias("start"))
    listed = ", ".join(str(row) for row in frame_schedule(shares))
    frame = docs.sparkSession.sql(f"select * from values {listed} as t(number, turn, at, released, due)")
    rank, share = F.col("position") - F.col("start"), F.element_at(F.array(*[F.lit(a) for a in shares]), F.col("number") + 1)
    rows = rows.join(F.broadcast(starts), "number").withColumn("block", F.floor(rank / block_rows)).withColumn("place", rank % block_rows)
    rows = rows.withColumn("frame", F.floor(F.col("block") / share))
    rows = rows.withColumn("turn", (F.col("block") - F.col("frame") * share).cast("int"))
    begin = F.col("frame") * slots
    values = {"slot": begin + F.col("at"), "place": F.col("place"), "block": F.col("block"), "release": begin + F.col("released"), "deadline": begin + F.col("due")}
    return rows.join(F.broadcast(frame), ["number", "turn"]).select("row.*", *[v.alias(prefix + n) for n, v in values.items()])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All of ``docs`` in the order of the mixture, with ``mix_slot`` and ``mix_place``."""
    prefix = fresh(docs, "mix_")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    mixed = mix(docs, WEIGHTS, REST, prefix=prefix).select(*columns(docs), f"{prefix}slot", f"{prefix}place")
    return mixed.orderBy(f"{prefix}slot", f"{prefix}place")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs, WEIGHTS, REST)


_NAMED = ", ".join(f"('{name}', {i}, {a})" for i, (name, a) in enumerate(WEIGHTS.items()))
_SHARES = [*WEIGHTS.values(), REST]
_SLOTS = sum(_SHARES)

OP3_SQL = f"""
with recursive named(source, g, a) as (values {_NAMED}),
shares as (select {_SHARES} as a),
edf(slot, g, release, deadline, done) as (
    select -1, -1, 0, 0, [{', '.join('0' for _ in _SHARES)}]
    union all
    select slot + 1, pick.g, pick.r, pick.d, [case when i = pick.g then done[i + 1] + 1 else done[i + 1] end for i in range({len(_SHARES)})]
    from (
        select slot, done, list_sort([
            {{'d': ((done[i + 1] + 1) * {_SLOTS} + a[i + 1] - 1) // a[i + 1], 'g': i, 'r': done[i + 1] * {_SLOTS} // a[i + 1]}}
            for i in range({len(_SHARES)}) if done[i + 1] < a[i + 1] and done[i + 1] * {_SLOTS} // a[i + 1] <= slot + 1
        ])[1] as pick
        from edf, shares where slot < {_SLOTS - 1}
    )
),
frame as (select slot, g, release, deadline, row_number() over (partition by g order by slot) - 1 as j from edf where slot >= 0),
ranked as (
    select doc_id, d.source, coalesce(g, {len(WEIGHTS)}) as g, coalesce(a, {REST}) as a,
           row_number() over (partition by coalesce(g, {len(WEIGHTS)}) order by substring(md5(cast(doc_id as varchar)), 1, 16), doc_id) - 1 as n
    from documents d left join named on d.source = named.source
)
select doc_id, source, cast((n // {BLOCK_ROWS}) // a * {_SLOTS} + slot as bigint) as slot, cast(n % {BLOCK_ROWS} as bigint) as place,
       cast(n // {BLOCK_ROWS} as bigint) as block, cast((n // {BLOCK_ROWS}) // a * {_SLOTS} + release as bigint) as release,
       cast((n // {BLOCK_ROWS}) // a * {_SLOTS} + deadline as bigint) as deadline
from ranked join frame on ranked.g = frame.g and (n // {BLOCK_ROWS}) % a = j
"""
