"""Zero cells for the link matrix: a stated number per row block, drawn at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.cells import block_size, div, row_block
from linkloom.operators.links import Shape
from linkloom.operators.positions import with_positions
from linkloom.runtime import written

SEED = 20190308
# Positives between which the free cells are drawn from by one permutation.
STRETCH = 64
# Zeros that one row makes.
RUN_ZEROS = 4096
ROUNDS = 4
PRIME = (1 << 31) - 1
FACTOR = 1_103_515_245


def dedupe_cells(cells: DataFrame) -> DataFrame:
    """One cell per coordinate."""
    return cells.groupBy("row", "col").agg(F.max("value").alias("value"))


def block_filter(cells: DataFrame, start: int, end: int) -> DataFrame:
    """Cells of rows in ``[start, end)``."""
    return cells.where((F.col("row") >= start) & (F.col("row") < end))


def row_density(cells: DataFrame, rows: int) -> DataFrame:
    """``(density)``: cells per row, repeats counted."""
    return cells.agg((F.count(F.lit(1)) / F.lit(rows)).alias("density"))


def anti_positive_cells(candidates: DataFrame, cells: DataFrame) -> DataFrame:
    """Candidates whose coordinate is not taken."""
    return candidates.join(cells.select("row", "col"), ["row", "col"], "left_anti")


def union_zeros(cells: DataFrame, zeros: DataFrame) -> DataFrame:
    """``(row, col, value)`` with the zero cells as 0.0."""
    zero = zeros.select("row", "col", F.lit(0.0).cast("float").alias("value"))
    return cells.select("row", "col", "value").unionByName(zero)


def zeros_per_block(total: int, shape: Shape, blocks: int, factor: float = 1.0) -> list[int]:
    """Zero cells wanted in each row block: its rows times the density, rounded down."""
    density = float(total) / shape.rows
    size = block_size(shape.rows, blocks)
    return [int(density * _block_rows(b, size, shape.rows) * factor) for b in range(blocks)]


def _block_rows(block: int, size: int, rows: int) -> int:
    return max(0, min(size, rows - block * size))


def inject_zeros(
    cells: DataFrame, shape: Shape, blocks: int, total: int | None = None, factor: float = 1.0, seed: int = SEED
) -> DataFrame:
    """``(block, row, col)``: in each row block the wanted number of free cells.

    ``cells`` are the deduplicated positives; ``total`` counts them with repeats. The positives of a block, in
    order, cut it into stretches with :data:`STRETCH` of them each. A stretch gets its share of the zeros by the free cells before and in
    it, and its ``i``-th zero is the free cell number ``permuted(i)``, found by counting the positives before it. So the zeros are
    distinct and free from the start: none is drawn twice, looked up or thrown away, and draws are not moved between tasks.
    """
    spark = cells.sparkSession
    wanted = zeros_per_block(cells.count() if total is None else total, shape, blocks, factor)
    # One number per block: the same few the caller asked for.
    taken = {r["block"]: r["count"] for r in _per_block(cells, shape, blocks).collect()}
    size = block_size(shape.rows, blocks)
    whole = [_block_rows(b, size, shape.rows) * shape.cols for b in range(blocks)]
    short = [b for b in range(blocks) if wanted[b] > whole[b] - taken.get(b, 0)]
    if short:
        raise ValueError(f"row blocks {short} have fewer free cells than zeros wanted")
    targets = [(b, whole[b], whole[b] - taken.get(b, 0), wanted[b]) for b in range(blocks) if wanted[b]]
    targets = spark.createDataFrame(targets, "block bigint, cells bigint, block_free bigint, wanted bigint")
    shares = with_shares(_stretches(cells, shape, blocks), targets, seed)
    # A stretch with a wide gap may have many zeros: they are made in runs, and runs are spread over tasks.
    runs = F.sequence(F.lit(0).cast("bigint"), div(F.col("zeros") - 1, RUN_ZEROS))
    runs = shares.where("zeros > 0").withColumn("run", F.explode(runs)).repartition("block", "stretch", "run")
    first = F.col("run") * RUN_ZEROS
    numbers = F.sequence(first, F.least(first + RUN_ZEROS, F.col("zeros")) - 1)
    drawn = runs.withColumn("number", F.explode(numbers)).withColumn("rank", permuted(F.col("number"), F.col("free"), F.col("keys")))
    passed = F.size(F.filter("gaps", lambda gap: gap <= F.col("rank")))
    cell = F.col("low") + F.col("rank") + passed
    drawn = drawn.select("block", cell.alias("cell"))
    return drawn.select("block", (F.col("block") * size + div(F.col("cell"), shape.cols)).alias("row"), (F.col("cell") % shape.cols).alias("col"))


def _stretches(cells: DataFrame, shape: Shape, blocks: int) -> DataFrame:
    """``block, stretch, places``, written: the sorted cell numbers of each :data:`STRETCH` positives of a block."""
    block = row_block(F.col("row"), shape.rows, blocks).cast("bigint")
    size = block_size(shape.rows, blocks)
    place = (F.col("row") - block * size).cast("bigint") * shape.cols + F.col("col")
    numbered = with_positions(cells.select(block.alias("block"), place.alias("place")), "block", "place", name="at")
    numbered = written(numbered, "numbered-positives")
    starts = numbered.groupBy("block").agg(F.min("at").alias("start"))  # one row per block
    numbered = numbered.join(F.broadcast(starts), "block").withColumn("stretch", div(F.col("at") - F.col("start"), STRETCH))
    return written(numbered.groupBy("block", "stretch").agg(F.array_sort(F.collect_list("place")).alias("places")), "stretches")


def with_shares(stretches: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``block, stretch, low, free, gaps, zeros, keys`` of each stretch of the blocks in ``targets``.

    A stretch goes from its first positive, or the beginning of the block, to the first of the next one. ``gaps`` are the
    free cells in it before each of its positives. Shares are rounded down at the same free cell for neighbours, so that they add up.
    """
    zero = F.lit(0).cast("bigint")
    ends = stretches.select("block", (F.col("stretch") - 1).alias("stretch"), F.get("places", F.lit(0)).alias("high"))
    # A block without positives is one stretch. One row per block.
    rows = targets.join(stretches, "block", "left").withColumn("stretch", F.coalesce("stretch", zero))
    rows = rows.join(ends, ["block", "stretch"], "left")
    rows = rows.withColumn("places", F.coalesce("places", F.array().cast("array<bigint>")))
    rows = rows.withColumn("low", F.when(F.col("stretch") == 0, zero).otherwise(F.get("places", F.lit(0))))
    rows = rows.withColumn("free", F.coalesce("high", "cells") - F.col("low") - F.size("places"))
    gaps = F.transform("places", lambda p, i: p - F.col("low") - i)
    before = F.col("low") - F.col("stretch") * STRETCH
    # The product of two of these numbers may not fit a long.
    free, wanted = (F.col(c).cast("decimal(19,0)") for c in ("block_free", "wanted"))

    def share(cells_before: Column) -> Column:
        return F.call_function("div", cells_before.cast("decimal(19,0)") * wanted, free).cast("bigint")

    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("block"), F.col("stretch")).cast("binary"))
    keys = F.array(*[F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("bigint") for i in range(ROUNDS)])
    zeros = share(before + F.col("free")) - share(before)
    return rows.select("block", "stretch", "low", "free", gaps.alias("gaps"), zeros.alias("zeros"), keys.alias("keys"))


def permuted(number: Column, size: Column, keys: Column) -> Column:
    """A keyed permutation of the numbers below ``size``: a Feistel network on pairs, walked along its cycle until a number is below.

    Pairs (left, right) of numbers below ``a`` and ``b``, with ``a * b`` at least ``size`` and less than ``size + a``, so that hardly any number has
    to go on; one that does is back after fewer than ``a`` steps.
    """
    a = F.floor(F.sqrt(size.cast("double"))).cast("bigint") + 1
    b = F.call_function("div", size + a - 1, a)
    once = _feistel(number, a, b, keys)
    steps = F.sequence(F.lit(1).cast("bigint"), F.greatest(a * b - size, F.lit(1).cast("bigint")))
    walk = F.aggregate(steps, once, lambda x, _: F.when(x < size, x).otherwise(_feistel(x, a, b, keys)))
    return F.when(once < size, once).otherwise(walk)


def _feistel(x: Column, a: Column, b: Column, keys: Column) -> Column:
    left, right = x % a, F.call_function("div", x, a)
    for i in range(ROUNDS):
        key = F.get(keys, F.lit(i))
        if i % 2 == 0:
            left = (left + _mixed(right, key)) % a
        else:
            right = (right + _mixed(left, key)) % b
    return left + right * a


def _mixed(x: Column, key: Column) -> Column:
    """A keyed number below a prime of 31 bits; no product outgrows 64 bits."""
    t = (x + key) % PRIME
    return ((t * t) % PRIME * FACTOR) % PRIME


def _per_block(cells: DataFrame, shape: Shape, blocks: int) -> DataFrame:
    return cells.groupBy(row_block(F.col("row"), shape.rows, blocks).alias("block")).count()
