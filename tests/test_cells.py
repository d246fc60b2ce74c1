import math
import random
import struct
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from linkloom.functions.cells import block_size, hash_shard, row_block
from linkloom.operators import batch_index, batches, zeros
from linkloom.operators.links import Shape
from linkloom.runtime import written
from linkloom.sources.coo import read_coo, write_coo
from linkloom.sources.sinks import write_cells


def matrix(rows, cols, points, seed=20190318):
    rng, cells = random.Random(seed), set()
    while len(cells) < points:
        cells.add((rng.randrange(rows), rng.randrange(cols)))
    return cells


def stored(spark, cells, rows, shards):
    df = spark.createDataFrame([(r, c, 1.0) for r, c in sorted(cells)], "row long, col long, value float")
    return written(df.withColumn("shard", row_block(F.col("row"), rows, shards)), "cells")


def coordinates(df):
    return [(r["row"], r["col"]) for r in df.select("row", "col").collect()]


def check_batches(df, size, points):
    rows = df.select("seq", "batch_id").collect()
    assert sorted(r["seq"] for r in rows) == list(range(points))
    assert all(r["batch_id"] == r["seq"] // size for r in rows)


def test_shards_split_the_keys(spark):
    keys = spark.range(1000).select(F.col("id"), hash_shard(F.col("id"), 8).alias("shard"))
    import zlib

    assert all(r["shard"] == zlib.crc32(str(r["id"]).encode()) % 8 for r in keys.collect())


@pytest.mark.parametrize("chunk", [16 * 1024, 4])
def test_basic_batches(spark, chunk):
    cells = matrix(10, 10, 18)
    df = batches.batch_sequential(stored(spark, cells, 10, 2), 4)
    check_batches(df, 4, 18)
    assert batches.num_batches(18, 4) == 5 == len({r["batch_id"] for r in df.collect()})
    assert set(coordinates(df)) == cells
    merged = batches.batch_merged(stored(spark, cells, 10, 2), 4, chunk)
    check_batches(merged, 4, 18)


def test_sequential_goes_shard_by_shard(spark):
    cells = matrix(100, 100, 2000)
    df = batches.batch_sequential(stored(spark, cells, 100, 4), 64)
    assert set(coordinates(df)) == cells
    assert df.where("batch_id = 0").select("shard").distinct().count() == 1
    shards = [r["shard"] for r in df.orderBy("seq").collect()]
    assert shards == sorted(shards)


def test_merged_and_shuffled(spark):
    cells = matrix(100, 100, 2000)
    placed = batches.place_in_shards(stored(spark, cells, 100, 4))
    merged = written(batches.merge_shards(placed, 128), "merged")
    orders = []
    for epoch in (0, 0, 1):
        df = batches.with_batches(batches.shuffle_chunks(merged, seed=5, epoch=epoch), 64)
        check_batches(df, 64, 2000)
        assert set(coordinates(df)) == cells
        assert df.where("batch_id = 0").select("shard").distinct().count() == 4
        orders.append([(r["row"], r["col"]) for r in df.orderBy("seq").collect()])
        chunks = [r["chunk"] for r in df.orderBy("seq").collect()]
        assert chunks == sorted(chunks)
    assert orders[0] == orders[1] != orders[2]


def test_shuffle_within_chunks_of_one_shard(spark):
    cells = matrix(100, 100, 500)
    placed = batches.place_in_shards(stored(spark, cells, 100, 4))
    df = batches.shuffle_chunks(placed.withColumn("chunk", F.expr("pos div 16")), 5, chunk=("shard", "chunk"))
    rows = df.orderBy("seq").collect()
    keys = [(r["shard"], r["chunk"]) for r in rows]
    assert keys == sorted(keys) and {(r["row"], r["col"]) for r in rows} == cells


def test_no_partial_batch(spark):
    cells = matrix(100, 100, 999)
    df = batches.batch_merged(stored(spark, cells, 100, 4), 64, 16)
    full = batches.drop_partial_batch(df, 64, 999)
    assert full.count() == 960 and full.select("batch_id").distinct().count() == 15
    assert batches.num_batches(999, 64, allow_partial=False) == 15


@pytest.mark.parametrize("points", [99, 999, 3333, 4444, 5050, 6060, 9099])
def test_merge_by_definition(spark, points):
    """Chunk by chunk, shard by shard, as long as a shard has records."""
    cells = sorted(matrix(100, 100, points))
    size, shards = block_size(100, 8), {}
    for row, col in cells:
        shards.setdefault(row // size, []).append((row, col))
    want, start = [], 0
    while len(want) < points:
        for shard in sorted(shards):
            want += shards[shard][start : start + 7]
        start += 7
    df = batches.batch_merged(stored(spark, cells, 100, 8), 64, 7).orderBy("seq")
    assert coordinates(df) == want


def permuted_by_definition(number, size, keys):
    a = math.isqrt(size) + 1
    b = -(-size // a)

    def mixed(x, key):
        t = (x + key) % zeros.PRIME
        return t * t % zeros.PRIME * zeros.FACTOR % zeros.PRIME

    while True:
        left, right = number % a, number // a
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + mixed(right, key)) % a
            else:
                right = (right + mixed(left, key)) % b
        number = left + right * a
        if number < size:
            return number


def zeros_by_definition(cells, shape, blocks, total, factor, seed):
    """The free cells of each stretch of a block, written out and picked by number."""
    size, out = block_size(shape.rows, blocks), set()
    for block in range(blocks):
        rows = min(size, shape.rows - block * size)
        wanted = int(total / shape.rows * rows * factor)
        places = sorted((r - block * size) * shape.cols + c for r, c in cells if r // size == block)
        free = [x for x in range(rows * shape.cols) if x not in set(places)]
        heads = [0, *places[zeros.STRETCH :: zeros.STRETCH], rows * shape.cols]
        before = 0
        for stretch, (low, high) in enumerate(zip(heads, heads[1:])):
            mine = [x for x in free if low <= x < high]
            n = (before + len(mine)) * wanted // len(free) - before * wanted // len(free) if wanted else 0
            digest = md5(f"{seed}:{block}:{stretch}".encode()).hexdigest()
            keys = [int(digest[7 * i : 7 * i + 7], 16) for i in range(zeros.ROUNDS)]
            picked = [mine[permuted_by_definition(i, len(mine), keys)] for i in range(n)]
            out |= {(block, block * size + x // shape.cols, x % shape.cols) for x in picked}
            before += len(mine)
    return out


@pytest.mark.parametrize("rows, cols, points, blocks, factor", [(50, 40, 300, 4, 1.0), (10, 10, 45, 3, 0.6), (17, 9, 20, 1, 2.0), (20, 5, 10, 4, 0.0), (40, 7, 3, 8, 4.0)])
def test_zeros_by_definition(spark, monkeypatch, rows, cols, points, blocks, factor):
    monkeypatch.setattr(zeros, "STRETCH", 16)
    monkeypatch.setattr(zeros, "RUN_ZEROS", 5)
    cells, shape = matrix(rows, cols, points), Shape(rows, cols)
    df = stored(spark, cells, rows, blocks).select("row", "col", "value")
    got = zeros.inject_zeros(df, shape, blocks, points, factor, seed=3)
    want = zeros_by_definition(cells, shape, blocks, points, factor, 3)
    found = [(r["block"], r["row"], r["col"]) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    both = zeros.union_zeros(df, got)
    assert both.count() == points + len(want) == both.select("row", "col").distinct().count()


def test_permutation(spark):
    sizes = [*range(1, 60), 97, 1000, 4096]
    keys = F.array(*[F.lit(k).cast("bigint") for k in (11, 268435455, 0, 77777)])
    df = spark.createDataFrame([(n,) for n in sizes], "size bigint").withColumn("number", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    rows = df.select("size", "number", zeros.permuted(F.col("number"), F.col("size"), keys).alias("to")).collect()
    for n in sizes:
        mine = {r.number: r.to for r in rows if r.size == n}
        assert sorted(mine.values()) == list(range(n))
        assert mine == {i: permuted_by_definition(i, n, [11, 268435455, 0, 77777]) for i in range(n)}
    large = {r.number: r.to for r in rows if r.size == 4096}
    assert sum(abs(v - k) < 64 for k, v in large.items()) < 400  # neighbours are parted


def test_zeros_are_spread_over_all_free_cells(spark, monkeypatch):
    monkeypatch.setattr(zeros, "RUN_ZEROS", 100)
    cells, shape = matrix(300, 200, 500), Shape(300, 200)
    df = stored(spark, cells, 300, 1).select("row", "col", "value")
    hits = [0] * 10
    for seed in range(6):
        found = zeros.inject_zeros(df, shape, 1, 500, 2.0, seed)
        for r in found.collect():
            hits[r["row"] // 30] += 1
    assert sum(hits) == 6000 and all(abs(h - 600) < 60 for h in hits)


def test_draws_are_not_moved(spark):
    df = stored(spark, matrix(50, 40, 300), 50, 4).select("row", "col", "value")
    plan = zeros.inject_zeros(df, Shape(50, 40), 4)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("explode(sequence((run")]
    assert not any(word in above for word in ("Join", "Aggregate", "Repartition", "Window", "Sort"))


def test_zeros_may_fill_a_block_but_not_more(spark):
    cells, shape = matrix(4, 5, 10), Shape(4, 5)
    df = stored(spark, cells, 4, 1).select("row", "col", "value")
    assert zeros.inject_zeros(df, shape, 1, 10, 1.0).count() == 10
    with pytest.raises(ValueError, match="free cells"):
        zeros.inject_zeros(df, shape, 1, 11, 1.0)


def test_dedupe_and_blocks(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (0, 1, 1.0), (5, 2, 1.0)], "row long, col long, value float")
    assert sorted(coordinates(zeros.dedupe_cells(df))) == [(0, 1), (5, 2)]
    assert coordinates(zeros.block_filter(df, 5, 6)) == [(5, 2)]
    assert zeros.row_density(df, 6).first()[0] == 0.5


def test_read_binary_shards(spark, tmp_path):
    cells = sorted(matrix(100, 2**32 - 1, 1000))
    for shard in range(4):
        with open(tmp_path / f"data.bin.{shard:05d}-of-00004", "wb") as out:
            for row, col in cells:
                if row // 25 == shard and shard != 2:
                    out.write(struct.pack("<IIf", row, col, 1.0))
    (tmp_path / "data.bin.00000-of-00004").open("ab").write(b"rest")
    got = read_coo(spark, str(tmp_path), slice_records=7).orderBy("shard", "pos").collect()
    want = [c for c in cells if c[0] // 25 != 2]
    assert [(r["row"], r["col"]) for r in got] == want
    assert {r["shard"] for r in got} == {0, 1, 3} and {r["value"] for r in got} == {1.0}


def test_binary_round_trip(spark, tmp_path):
    df = stored(spark, matrix(100, 50, 700), 100, 4)
    write_coo(df, str(tmp_path / "m"), 4)
    back = read_coo(spark, str(tmp_path / "m")).select("shard", "row", "col", "value")
    key = "shard", "row", "col"
    assert [tuple(r) for r in back.orderBy(*key).collect()] == [
        tuple(r) for r in df.select("shard", "row", "col", "value").orderBy(*key).collect()
    ]


def test_write_cells(spark, tmp_path):
    df = stored(spark, matrix(100, 50, 700), 100, 4)
    write_cells(df, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 700


def _shards(spark, folder, cells, shards, **options):
    write_coo(stored(spark, cells, 100, shards), str(folder), shards, **options)


def test_a_set_of_shards_is_replaced_as_a_whole(spark, tmp_path):
    many, few = matrix(100, 100, 400, 1), matrix(100, 100, 90, 2)
    _shards(spark, tmp_path, many, 64)
    with pytest.raises(Exception, match="already holds shards"):
        _shards(spark, tmp_path, few, 32)
    assert set(coordinates(read_coo(spark, str(tmp_path)))) == many
    _shards(spark, tmp_path, few, 32, overwrite=True)
    rows = spark.read.format("cell_shards").option("slice_records", "7").load(str(tmp_path))
    assert rows.schema.simpleString() == "struct<shard:int,pos:bigint,row:bigint,col:bigint,value:float>"
    assert set(coordinates(rows)) == few and rows.select("shard", "pos").distinct().count() == 90
    names = sorted(p.name for p in tmp_path.iterdir())
    assert len(names) == 33 and "_shards.json" in names and "data.bin.00031-of-00032" in names


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    good = matrix(100, 100, 50)
    bad = spark.createDataFrame([(0, 1, 1, 1.0), (1, 1 << 40, 2, 1.0)], "shard int, row long, col long, value float")
    unsorted = spark.createDataFrame([(0, 1, 1, 1.0), (0, 2, 2, 1.0)], "shard int, row long, col long, value float").repartition(2, "row")
    with pytest.raises(Exception, match="32 bits"):
        write_coo(bad, str(tmp_path), 2)
    with pytest.raises(Exception, match="several tasks"):
        unsorted.repartitionByRange(2, "row").write.format("cell_shards").option("shards", "1").mode("append").save(str(tmp_path))
    assert list(tmp_path.iterdir()) == [] and read_coo(spark, str(tmp_path)).count() == 0
    _shards(spark, tmp_path, good, 4)
    with pytest.raises(Exception, match="32 bits"):
        write_coo(bad, str(tmp_path), 4, overwrite=True)
    assert set(coordinates(read_coo(spark, str(tmp_path)))) == good


def test_mixed_and_broken_sets_are_refused(spark, tmp_path):
    _shards(spark, tmp_path, matrix(100, 100, 50), 4)
    (tmp_path / "data.bin.00000-of-00002").write_bytes(b"")
    with pytest.raises(Exception, match="several sets"):
        read_coo(spark, str(tmp_path)).count()
    (tmp_path / "data.bin.00000-of-00002").unlink()
    (tmp_path / "data.bin.00000-of-00004").write_bytes(b"x" * 12)
    with pytest.raises(Exception, match="not those that were written"):
        read_coo(spark, str(tmp_path)).count()
    (tmp_path / "_replacing").touch()
    with pytest.raises(Exception, match="being replaced"):
        read_coo(spark, str(tmp_path)).count()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    cells = matrix(100, 100, 3000)
    placed = written(batches.place_in_shards(stored(spark, cells, 100, 4)), "placed")
    path = str(tmp_path_factory.mktemp("batches") / "store")
    batch_index.write_batch_store(placed, path, group_bytes=4096)
    return path, placed


@pytest.mark.parametrize("size, wanted", [(64, [0, 7, 46, 47, 99]), (64, [7, 7, None]), (1000, [2]), (1, [0, 1500, 2999]), (10_000, [0]), (64, [])])
def test_batches_by_index(spark, store, size, wanted):
    path, placed = store
    asked = spark.createDataFrame([(w,) for w in wanted], "batch_id long")
    got = batch_index.fetch_batches(spark, path, asked, size).select("shard", "row", "col", "value", "seq", "batch_id").collect()
    chosen = batches.with_batches(placed, size).where(F.col("batch_id").isin([w for w in wanted if w is not None] or [-1]))
    want = chosen.select("shard", "row", "col", "value", "seq", "batch_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    # No row group is read but those that hold a position asked for.
    groups = {(r["file"], r["row_group"]) for r in batch_index.covering_groups(spark, path, asked, size).collect()}
    index = spark.read.parquet(f"{path}/index").collect()
    places = [r["seq"] for r in want]
    assert groups == {(r["file"], r["row_group"]) for r in index if any(r["first"] <= p <= r["last"] for p in places)}
    assert len(index) > 8


def test_index_covers_all_positions_once(spark, store):
    path, _ = store
    index = sorted((r["first"], r["last"]) for r in spark.read.parquet(f"{path}/index").collect())
    assert index[0][0] == 0 and index[-1][1] == 2999
    assert all(a[1] + 1 == b[0] for a, b in zip(index, index[1:]))


def test_store_is_not_written_over(spark, store):
    path, placed = store
    with pytest.raises(Exception, match="exist"):
        batch_index.write_batch_store(placed, path)


def test_store_without_cells(spark, tmp_path):
    empty = spark.createDataFrame([], "shard int, row long, col long, value float, seq long")
    batch_index.write_batch_store(empty, str(tmp_path / "none"))
    asked = spark.createDataFrame([(0,)], "batch_id long")
    assert batch_index.fetch_batches(spark, str(tmp_path / "none"), asked, 4).collect() == []


def test_short_slices_share_a_task(spark, tmp_path):
    rows = [(i % 2, i, 3 * i, float(i)) for i in range(3000)]
    write_coo(spark.createDataFrame(rows, "shard int, row long, col long, value float"), str(tmp_path), 2)
    read = read_coo(spark, str(tmp_path), slice_records=7)
    assert read.rdd.getNumPartitions() == 2
    got = [tuple(r) for r in read.orderBy("shard", "pos").collect()]
    assert got == [(s, n, 2 * n + s, 3 * (2 * n + s), float(2 * n + s)) for s in (0, 1) for n in range(1500)]
