"""Many small chunks: a folder ``chunk=<k>`` for each, written and read by the tasks themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import chomp
from linkloom.runtime import exists, ship_package
from linkloom.sources.cell_shards import SCHEMES, _runs, open_path, qualified

# Bytes of a file that a task reads at once.
PIECE = 8 << 20


def write_chunks(lines: DataFrame, path: str, *order: str) -> None:
    """Write ``value`` in ``order``, which begins with ``chunk``, to one folder per chunk.

    Chunks may be as many as a fraction of the lines. Each task opens its files directly, and as many tasks do so as a shuffle has,
    however few bytes they get. A chunk that lies on the border of two tasks has a file of each, in order. A file gets its name when it is
    whole, so a task that runs again replaces what it had written; ``_SUCCESS`` is written last.
    """
    spark = lines.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    if "://" in path and not path.startswith("file:") and path.split("://", 1)[0] not in SCHEMES:
        ordered.select("chunk", "value").write.partitionBy("chunk").text(path)  # a store that tasks open by the JVM only
        return
    if exists(spark, path):
        raise FileExistsError(path)
    ship_package(spark)
    folder = qualified(spark, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_path(folder)
        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        hidden = f".{name}-{uuid.uuid4().hex}"
        chunk, sink, files = None, None, 0

        def finish() -> None:
            if sink is not None:
                sink.close()
                filesystem.move(f"{base}/chunk={chunk}/{hidden}", f"{base}/chunk={chunk}/{name}")

        for batch in batches:
            of, values = batch.column("chunk").to_numpy(), batch.column("value").to_pylist()
            for low, high in _runs(of):
                if of[low] != chunk:
                    finish()
                    chunk, files = int(of[low]), files + 1
                    filesystem.create_dir(f"{base}/chunk={chunk}")
                    sink = filesystem.open_output_stream(f"{base}/chunk={chunk}/{hidden}", compression=None)
                sink.write(b"\n".join(values[low:high]) + b"\n")
        finish()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    # Bytes, as a line need not be valid UTF-8.
    rows = ordered.select(F.col("chunk").cast("bigint").alias("chunk"), F.coalesce(F.col("value").cast("binary"), F.lit(b"")).alias("value"))
    rows.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
    filesystem, base = open_path(folder)
    filesystem.create_dir(base)
    filesystem.open_output_stream(f"{base}/_SUCCESS").close()


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``(chunk, value, file, block, slot)``: lines of the folders of :func:`write_chunks`, placed as those of ``read_lines``.

    The driver lists the folders, one name per chunk; tasks list the files and read them.
    """
    ship_package(spark)
    folder = qualified(spark, path)
    filesystem, base = open_path(folder)
    found = (i.base_name for i in filesystem.get_file_info(fs.FileSelector(base)) if i.base_name.startswith("chunk="))
    chunks = spark.createDataFrame(pa.table({"chunk": pa.array([int(name.removeprefix("chunk=")) for name in found], pa.int64())}))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_path(folder)
        for batch in batches:
            for chunk in batch.column("chunk").to_pylist():
                files = filesystem.get_file_info(fs.FileSelector(f"{base}/chunk={chunk}"))
                for name in sorted(i.base_name for i in files if not i.base_name.startswith((".", "_"))):
                    yield from lines_of(filesystem, f"{base}/chunk={chunk}/{name}", chunk, name)

    def lines_of(filesystem: fs.FileSystem, where: str, chunk: int, name: str) -> Iterator[pa.RecordBatch]:
        rest, slot = b"", 0
        with filesystem.open_input_stream(where, compression=None) as source:
            while data := source.read(PIECE):
                *values, rest = (rest + data).split(b"\n")
                if values:
                    yield rows(values, chunk, name, slot)
                slot += len(values)
        if rest:
            yield rows([rest], chunk, name, slot)

    def rows(values: list[bytes], chunk: int, name: str, slot: int) -> pa.RecordBatch:
        file = f"{folder.rstrip('/')}/chunk={chunk}/{name}"
        columns = {"chunk": pa.array([chunk] * len(values), pa.int64()), "value": pa.array(values, pa.binary()), "file": [file] * len(values)}
        slots = pa.array(range(slot, slot + len(values)), pa.int64())
        return pa.RecordBatch.from_pydict({**columns, "block": pa.array([0] * len(values), pa.int64()), "slot": slots})

    lines = chunks.repartition(parts, "chunk").mapInArrow(read, "chunk bigint, value binary, file string, block bigint, slot bigint")
    return lines.withColumn("value", chomp(F.col("value").cast("string")))
