"""The binary shard files of the link matrix as a data source: ``spark.read.format("cell_shards")``.

A set of shards appears as a whole or not at all. Tasks write under a folder of their job; the commit on the driver moves
the files of the attempts that counted into place and names them, with their records, in a manifest. While a set is replaced a marker
stands in the folder, and readers refuse it, as they refuse files of several sets or files that the manifest does not name.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from linkloom.runtime import ship_package

FORMAT = "cell_shards"
# Record layout (little endian) and shard file names.
RECORD = np.dtype([("row", "<u4"), ("col", "<u4"), ("value", "<f4")])
SHARD_FILE = re.compile(r"data\.bin\.(\d+)-of-(\d+)$")
SCHEMA = "shard int, pos bigint, row bigint, col bigint, value float"
# Records read by one task step, and those that a task reads step by step if its steps are shorter: a task costs more than a short step.
SLICE_RECORDS = 4 << 20
TASK_RECORDS = 1 << 20
MANIFEST, REPLACING = "_shards.json", "_replacing"

# Schemes of stores that the tasks can open without the JVM, by the name they have there.
SCHEMES = {"hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for tasks that read or write bytes; other stores are refused with a reason."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    if scheme not in SCHEMES:
        raise ValueError(f"binary shards cannot be kept under {scheme}://, only under {', '.join(SCHEMES)} or files; use Parquet")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{rest}")


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the file system that Spark would take it from, so that all tasks mean the same one."""
    if "://" in folder or folder.startswith("file:"):
        if not folder.startswith("file:") and folder.split("://", 1)[0] not in SCHEMES:
            open_path(folder)  # refuses it, before any work
        return folder
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def shard_name(shard: int, shards: int) -> str:
    return f"data.bin.{shard:05d}-of-{shards:05d}"


@dataclass(frozen=True)
class ShardFile:
    shard: int
    name: str
    records: int


def shard_files(folder: str) -> list[ShardFile]:
    """The one set of shards in a folder; several sets or a broken one are errors."""
    filesystem, base = open_path(folder)
    found = {info.base_name: info for info in filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))}
    if REPLACING in found:
        raise ValueError(f"the shards in {folder} are being replaced, or replacing them broke off; write them again")
    named = {name: SHARD_FILE.match(name) for name in found}
    files = [ShardFile(int(m[1]), name, found[name].size // RECORD.itemsize) for name, m in named.items() if m]
    if len({int(m[2]) for m in named.values() if m}) > 1:
        raise ValueError(f"{folder} holds shards of several sets")
    if MANIFEST in found:
        with filesystem.open_input_file(f"{base}/{MANIFEST}") as source:
            listed = {item["name"]: item["records"] for item in json.loads(source.read())}
        if listed != {f.name: f.records for f in files}:
            raise ValueError(f"the shards in {folder} are not those that were written")
    return sorted(files, key=lambda f: f.shard)


@dataclass
class Slices(InputPartition):
    """Records of one shard file which a task reads, ``step`` at once."""

    path: str
    shard: int
    first: int
    count: int
    step: int


class CellShardReader(DataSourceReader):
    def __init__(self, folder: str, slice_records: int):
        self.folder, self.slice_records = folder, slice_records

    def partitions(self) -> list[Slices]:
        step = self.slice_records
        task = step * max(1, TASK_RECORDS // step)
        return [
            Slices(f"{self.folder.rstrip('/')}/{f.name}", f.shard, first, min(task, f.records - first), step)
            for f in shard_files(self.folder)
            for first in range(0, f.records, task)
        ]

    def read(self, partition: Slices | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark makes of no partitions
            return
        filesystem, path = open_path(partition.path)
        width, end = RECORD.itemsize, partition.first + partition.count
        with filesystem.open_input_file(path) as source:
            for first in range(partition.first, end, partition.step):
                data = np.frombuffer(source.read_at(min(partition.step, end - first) * width, first * width), RECORD)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(data), partition.shard, np.int32)),
                        pa.array(np.arange(first, first + len(data))),
                        pa.array(data["row"].astype(np.int64)),
                        pa.array(data["col"].astype(np.int64)),
                        pa.array(data["value"]),
                    ],
                    names=["shard", "pos", "row", "col", "value"],
                )


@dataclass
class Written(WriterCommitMessage):
    """Shard files of one task: shard, name under the folder of the job, records."""

    files: list[tuple[int, str, int]]


class CellShardWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, shards: int, overwrite: bool):
        self.folder, self.shards, self.overwrite = folder, shards, overwrite
        self.job = f"_job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        filesystem, base = open_path(self.folder)
        filesystem.create_dir(f"{base}/{self.job}")
        files: list[tuple[int, str, int]] = []
        sink, shard, records = None, None, 0
        for batch in iterator:
            of = batch.column("shard").to_numpy()
            data = np.empty(len(batch), RECORD)
            for column in RECORD.names:
                values = batch.column(column).to_numpy()
                if column != "value" and len(values) and not 0 <= values.min() <= values.max() < 1 << 32:
                    raise ValueError("the binary form holds rows and columns of 32 bits only; use Parquet")
                data[column] = values
            for low, high in _runs(of):
                if of[low] != shard:
                    if sink is not None:
                        sink.close()
                        files[-1] = (*files[-1][:2], records)
                    shard, records = int(of[low]), 0
                    if not 0 <= shard < self.shards:
                        raise ValueError(f"shard {shard} is none of {self.shards}")
                    files.append((shard, f"{uuid.uuid4().hex}-{shard}", 0))
                    sink = filesystem.open_output_stream(f"{base}/{self.job}/{files[-1][1]}")
                sink.write(data[low:high].tobytes())
                records += high - low
        if sink is not None:
            sink.close()
            files[-1] = (*files[-1][:2], records)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        filesystem, base = open_path(self.folder)
        filesystem.create_dir(f"{base}/{self.job}")
        try:
            self._move(filesystem, base, [f for m in messages if m is not None for f in m.files])
        finally:
            filesystem.delete_dir(f"{base}/{self.job}")

    def _move(self, filesystem: fs.FileSystem, base: str, files: list[tuple[int, str, int]]) -> None:
        if len({shard for shard, _, _ in files}) < len(files):
            raise ValueError("a shard came from several tasks: the cells have to be partitioned by shard and sorted")
        there = [i.base_name for i in filesystem.get_file_info(fs.FileSelector(base))]
        old = [name for name in there if SHARD_FILE.match(name) or name == MANIFEST]
        if (old or REPLACING in there) and not self.overwrite:
            raise ValueError(f"{self.folder} already holds shards")
        filesystem.open_output_stream(f"{base}/{REPLACING}").close()
        for name in old:
            filesystem.delete_file(f"{base}/{name}")
        known = {shard: (name, records) for shard, name, records in files}
        listed = []
        for shard in range(self.shards):
            name, records = known.get(shard, (None, 0))
            final = shard_name(shard, self.shards)
            if name is None:  # a shard without cells is an empty file
                filesystem.open_output_stream(f"{base}/{final}").close()
            else:
                filesystem.move(f"{base}/{self.job}/{name}", f"{base}/{final}")
            listed.append({"name": final, "records": records})
        with filesystem.open_output_stream(f"{base}/{MANIFEST}") as sink:
            sink.write(json.dumps(listed).encode())
        filesystem.delete_file(f"{base}/{REPLACING}")

    def abort(self, messages: list[Written | None]) -> None:
        filesystem, base = open_path(self.folder)
        if filesystem.get_file_info(f"{base}/{self.job}").type == fs.FileType.Directory:
            filesystem.delete_dir(f"{base}/{self.job}")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1 if len(values) else np.zeros(0, dtype=int)
    bounds = [0, *cuts.tolist(), len(values)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


class CellShards(DataSource):
    """Options: ``path``, for reading ``slice_records``, for writing ``shards``. ``append`` refuses a folder with shards."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> CellShardReader:
        return CellShardReader(self.options["path"], int(self.options.get("slice_records", SLICE_RECORDS)))

    def writer(self, schema: StructType, overwrite: bool) -> CellShardWriter:
        return CellShardWriter(self.options["path"], int(self.options["shards"]), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    ship_package(spark)
    spark.dataSource.register(CellShards)
