"""Tuples of dump lines of any length: ranges of one line are parsed by different tasks.

A file is read as pieces between closing parentheses, which Spark cuts into splits wherever they fall. Each split is
first gone through for what it does from every state it may begin in; putting these together, a row per split, tells the state
in which each really begins, its line and how many tuples of the line came before. With that, every split gives its tuples. One
that lies in several splits comes as several parts, which are joined by its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.automaton import BETWEEN, BROKEN, DONE, OPEN, PLAIN, QUOTED, STATES, Pieces, Range, ends_badly, scan
from linkloom.functions.dump import raw_fields
from linkloom.operators.lookup import lookup_join
from linkloom.runtime import new_path, ship_package, written

_RANGE = "file string, block bigint, state array<int>, tuples array<bigint>, table array<binary>, feeds bigint"
_START = "file string, block bigint, state int, line bigint, pos bigint, table binary"
_FOUND = "file string, line bigint, table string, pos bigint, block bigint, whole boolean, tuple string"
_SPLIT_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")


@contextmanager
def _same_splits(spark: SparkSession, range_bytes: int | None) -> Iterator[None]:
    """Cut files into the same splits in every reading inside, of at most ``range_bytes`` if that is given."""
    before = {key: spark.conf.get(key, None) for key in _SPLIT_SIZES}
    try:
        if range_bytes is not None:
            spark.conf.set(_SPLIT_SIZES[0], str(range_bytes))
            spark.conf.set(_SPLIT_SIZES[1], str(range_bytes))
        # Otherwise the number of splits follows the executors there are at the time.
        spark.conf.set(_SPLIT_SIZES[2], before[_SPLIT_SIZES[2]] or str(spark.sparkContext.defaultParallelism))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, file, block)``: bytes between closing parentheses, in order within each split of a file."""
    raw = spark.read.option("lineSep", ")").text(path)
    return raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Slices of batches that lie in one split."""
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        low = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or (files[i], blocks[i]) != (files[low], blocks[low]):
                yield (files[low], blocks[low]), batch.slice(low, i - low)
                low = i


def split_functions(pieces: DataFrame) -> DataFrame:
    """``file, block, state, tuples, table, feeds``: what each split does from every state, lists by state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, Range()
        for split, part in _by_split(batches):
            if split != at:
                if at is not None:
                    yield _function_row(at, whole)
                at, whole = split, Range()
            whole.add(Pieces(part.column("value")))
        if at is not None:
            yield _function_row(at, whole)

    return pieces.mapInArrow(run, _RANGE)


def _function_row(at: tuple[str, int], whole: Range) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([whole.state], pa.list_(pa.int32())),
            pa.array([whole.tuples], pa.list_(pa.int64())), pa.array([whole.table], pa.list_(pa.binary())), pa.array([whole.feeds], pa.int64()),
        ],
        ["file", "block", "state", "tuples", "table", "feeds"],
    )


def split_starts(functions: DataFrame) -> DataFrame:
    """``file, block, state, line, pos, table`` at the beginning of each split; ``block`` is null at the end of a file."""

    def put_together(file: pd.DataFrame) -> pd.DataFrame:
        file = file.sort_values("block")
        starts = scan(file.to_dict("records"))
        rows = pd.DataFrame(starts)
        rows["file"], rows["block"] = file["file"].iloc[0], pd.array([*file["block"], None], dtype="Int64")
        return rows[["file", "block", "state", "line", "pos", "table"]]

    # A row per split: a file of a terabyte has some thousands.
    return functions.groupBy("file").applyInPandas(put_together, _START)


def _tuples(spark: SparkSession, pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Tuples and parts of tuples of each split; ``pos`` -1 stands for a malformed line."""
    known = starts.where(F.col("block").isNotNull()).withColumnsRenamed({"file": "_file", "block": "_block"})
    # One row per split. A split without a start would be one that was cut otherwise the first time.
    rows = pieces.join(F.broadcast(known), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader = None, None
        for split, part in _by_split(batches):
            if split != at:
                if reader is not None:
                    yield reader.rows(True)
                start = {name: part.column(name)[0].as_py() for name in ("state", "line", "pos", "table")}
                if start["state"] is None:
                    raise RuntimeError(f"{split[0]} was cut into other splits than before at byte {split[1]}")
                at, reader = split, _Reader(split, **start)
            reader.read(Pieces(part.column("value")))
            yield reader.rows(False)
        if reader is not None:
            yield reader.rows(True)

    return rows.select("value", "file", "block", "state", "line", "pos", "table").mapInArrow(run, _FOUND)


class _Reader:
    """Goes through a split from its true state and collects tuples, parts of them and malformed lines."""

    def __init__(self, split: tuple[str, int], state: int, line: int, pos: int, table: bytes | None):
        self.split, self.state, self.line, self.table = split, state, line, table
        # The open tuple, if there is one, was the last to begin.
        self.pos = pos - 1
        self.parts: list[bytes] | None = [] if state in (OPEN, QUOTED) else None
        self.whole = state not in (OPEN, QUOTED)
        self.found: list[tuple[int, str | None, int, bool, str | None]] = []

    def read(self, pieces: Pieces) -> None:
        states = pieces.before()[:, self.state].tolist()
        follows, feeds = pieces.follows.tolist(), pieces.feeds.tolist()
        for i, text in enumerate(pieces.texts):
            state, after = states[i], states[i + 1]
            if feeds[i]:
                self._feed(state, text)
                if i in pieces.heads:
                    self.table, place = pieces.heads[i]
                    self._begin(text[place:])
            elif state == PLAIN and i in pieces.heads:
                self.table, place = pieces.heads[i]
                self._begin(text[place:])
            elif state == BETWEEN and follows[i]:
                self._begin(text[text.index(b"(") :])
            elif state in (OPEN, QUOTED):
                self.parts.append(text)
            if self.parts is not None and after == BETWEEN:
                self._emit(b")".join([*self.parts, b""]))
                self.parts, self.whole = None, True
            elif after == BROKEN and state != BROKEN:
                self._malformed()
        self.state = states[-1]

    def _begin(self, text: bytes) -> None:
        self.pos, self.parts, self.whole = self.pos + 1, [text], True

    def _feed(self, state: int, text: bytes) -> None:
        lines = text.split(b"\n")
        for line in lines[:-1]:
            if ends_badly(state, line):
                self._malformed()
            state, self.line = PLAIN, self.line + 1
        self.pos, self.parts, self.whole, self.table = -1, None, True, None

    def _malformed(self) -> None:
        self.found.append((self.line, None, -1, True, None))
        self.parts = None

    def _emit(self, text: bytes) -> None:
        self.found.append((self.line, None if self.table is None else self.table.decode(errors="surrogateescape"), self.pos, self.whole, text.decode("latin-1")))

    def rows(self, last: bool) -> pa.RecordBatch:
        if last and self.parts is not None and self.state in (OPEN, QUOTED):
            self.whole = False
            self._emit(b")".join([*self.parts, b""]))
        lines, tables, places, whole, tuples = zip(*self.found, strict=True) if self.found else ([],) * 5
        n, self.found = len(lines), []
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.split[0]] * n, pa.string()), pa.array(lines, pa.int64()), pa.array(tables, pa.string()), pa.array(places, pa.int64()),
                pa.array([self.split[1]] * n, pa.int64()), pa.array(whole, pa.bool_()), pa.array(tuples, pa.string()),
            ],
            ["file", "line", "table", "pos", "block", "whole", "tuple"],
        )


def parse_dump_ranges(spark: SparkSession, path: str | list[str], on_error: str = "fail", range_bytes: int | None = None) -> DataFrame:
    """``file, line, table, pos, tuple, fields`` of every tuple of a dump, however long its lines.

    The same tuples as :func:`linkloom.operators.dumps.parse_dump_tuples` gives; ``line`` counts the lines of a file from 0. A line that begins a list
    and does not end it with a semicolon is malformed, even without any ``);`` in it, and blanks may stand before the semicolon; the name of a table holds no
    closing parenthesis. ``on_error`` is ``fail``, or ``drop`` to leave malformed lines out.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError(f"on_error must be 'fail' or 'drop', not {on_error!r}")
    ship_package(spark)
    with _same_splits(spark, range_bytes):
        pieces = read_pieces(spark, path)
        starts = written(split_starts(written(split_functions(pieces), "split-functions")), "split-starts")
        found = _partitioned(_tuples(spark, pieces, starts))
    # A list may not be open at the end of a file.
    bad = found.where("pos < 0").select("file", "line")
    left = starts.where(F.col("block").isNull() & ~F.col("state").isin(PLAIN, DONE)).select("file", "line")
    bad = written(bad.unionByName(left).distinct(), "malformed-lines")
    if not bad.isEmpty():
        if on_error == "fail":
            first = bad.orderBy("file", "line").first()
            raise ValueError(f"malformed tuple list: {first['file']}, line {first['line']}")
        found = lookup_join(found, bad, ["file", "line"], "left_anti", spread_by=["pos"])
    columns = ["file", "line", "table", "pos", "tuple"]
    whole = found.where("whole and pos >= 0").select(*columns)
    # Two parts or more of each tuple on the border of splits, in the order of these.
    parts = found.where("not whole and pos >= 0").groupBy("file", "line", "pos")
    ordered = F.array_sort(F.collect_list(F.struct("block", "tuple")))
    joined = parts.agg(F.max("table").alias("table"), F.array_join(F.transform(ordered, lambda p: p["tuple"]), "").alias("tuple"))
    return whole.unionByName(joined.select(*columns)).withColumn("fields", F.explode(F.array(raw_fields(F.col("tuple")))))


def _partitioned(found: DataFrame) -> DataFrame:
    """``found``, written with the few parts and malformed lines apart from whole tuples, so that neither reads the other."""
    path = new_path(found.sparkSession, "tuples")
    found.withColumn("_kind", F.expr("whole and pos >= 0")).write.partitionBy("_kind").parquet(path)
    return found.sparkSession.read.schema(found.withColumn("_kind", F.lit(True)).schema).parquet(path).drop("_kind")
