"""Dump lines to tuples, tuples to filtered dump lines or typed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.dump import bare_tuple, field_value, insert_parts, is_complete, is_insert, raw_fields, tuple_list
from linkloom.functions.text import bytes_to_text, parse_int, text_to_bytes
from linkloom.operators.lookup import lookup_join
from linkloom.runtime import written

# Place of a line in its input.
PLACE = ("file", "block", "slot")

# Positions and types of the fields of the three dumped tables.
PAGE = {
    "page_id": (0, "bigint"),
    "page_namespace": (1, "int"),
    "page_title": (2, "string"),
    "page_is_redirect": (4, "int"),
}
PAGELINKS = {
    "pl_from": (0, "bigint"),
    "pl_namespace": (1, "int"),
    "pl_title": (2, "string"),
    "pl_from_namespace": (3, "int"),
}
CATEGORYLINKS = {"cl_from": (0, "bigint"), "cl_to": (1, "string")}

ID_FIELD, NAMESPACE_FIELD, TITLE_FIELD = 0, 1, 2


@dataclass(frozen=True)
class FieldRule:
    """Keep a tuple if ``accept`` holds for the value of the field at ``position``.

    A tuple too short to have the field passes.
    """

    position: int
    accept: Callable[[Column], Column]


def parse_dump_tuples(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """One row per tuple: the columns of ``lines`` but ``value``, then ``table, pos, tuple, fields``.

    ``tuple`` and ``fields`` hold one character per byte; see :func:`field`.
    """
    kept = [c for c in lines.columns if c != "value"]
    inserts = lines.where(is_insert(F.col("value"))).select(*kept, bytes_to_text(F.col("value")).alias("_text"))
    # Each step leaves the longer text behind, so that no row of a tuple drags its line along.
    inserts = _once(inserts, "_parts", insert_parts(F.col("_text"))).select(
        *kept, text_to_bytes(F.col("_parts.table")).alias("table"), F.col("_parts.body").alias("_body")
    )
    inserts = _once(inserts, "_tuples", tuple_list(F.col("_body")))
    inserts = _once(inserts, "_complete", is_complete(F.col("_body"), F.col("_tuples")))
    if on_error == "drop":
        inserts = inserts.where("_complete")
        tuples = F.col("_tuples")
    elif on_error == "fail":
        message = F.concat(F.lit("malformed tuple list: "), F.substring("_body", 1, 200))
        tuples = F.when(F.col("_complete"), F.col("_tuples")).otherwise(F.raise_error(message).cast("array<string>"))
    else:
        raise ValueError(f"on_error must be 'fail' or 'drop', not {on_error!r}")
    exploded = inserts.select(*kept, "table", F.posexplode(tuples).alias("pos", "_item"))
    exploded = exploded.select(*kept, "table", "pos", bare_tuple(F.col("_item")).alias("tuple"))
    return _once(exploded, "fields", raw_fields(F.col("tuple")))


def malformed_inserts(lines: DataFrame) -> DataFrame:
    """The lines which ``parse_dump_tuples(..., on_error="drop")`` leaves out."""
    inserts = lines.where(is_insert(F.col("value")))
    inserts = _once(inserts, "_body", insert_parts(bytes_to_text(F.col("value")))["body"])
    return inserts.where(~is_complete(F.col("_body"), tuple_list(F.col("_body")))).select(*lines.columns)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    The optimizer copies a projected expression into every later use, which for a
    pattern over a long text costs more than all the rest; it does not copy the output
    of a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def field(position: int) -> Column:
    """Value of the field at ``position``, unquoted and unescaped; null if there is none."""
    return field_value(F.get("fields", F.lit(position)))


def tuple_id() -> Column:
    """Integer key of a tuple: its first field, as written."""
    return parse_int(F.get("fields", F.lit(ID_FIELD)))


def as_table(tuples: DataFrame, layout: dict[str, tuple[int, str]]) -> DataFrame:
    """Typed columns of the tuples, for example by :data:`PAGE`."""
    columns = []
    for name, (position, kind) in layout.items():
        value = field(position)
        columns.append((value if kind == "string" else parse_int(value).try_cast(kind)).alias(name))
    return tuples.select(*columns)


def filter_rules(tuples: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """Tuples which pass all rules; without rules, all of them."""
    if not rules:
        return tuples
    return tuples.where(reduce(and_, (_passes(rule) for rule in rules)))


def _passes(rule: FieldRule) -> Column:
    accepted = F.coalesce(rule.accept(field(rule.position)), F.lit(False))
    return _lacks(rule.position) | accepted


def _lacks(position: int) -> Column:
    return F.size("fields") <= position


def main_namespace_rule() -> FieldRule:
    return FieldRule(NAMESPACE_FIELD, lambda value: parse_int(value) == 0)


def filter_main_ns(tuples: DataFrame) -> DataFrame:
    return filter_rules(tuples, [main_namespace_rule()])


def require_int_key(tuples: DataFrame) -> DataFrame:
    """Tuples whose first field is an integer, with it as ``id``."""
    return _once(tuples, "id", tuple_id()).where(F.col("id").isNotNull())


def semi_by_id(tuples: DataFrame, ids: DataFrame, **limits: int) -> DataFrame:
    """Tuples whose first field is one of ``ids.id``; ``limits`` are those of :func:`lookup_join`."""
    keyed = _once(tuples, "_id", parse_int(field(ID_FIELD)))
    wanted = ids.select(F.col("id").alias("_id"))
    return lookup_join(keyed, wanted, ["_id"], "left_semi", _spread(tuples), stored=False, **limits).drop("_id")


def semi_by_title(tuples: DataFrame, titles: DataFrame, **limits: int) -> DataFrame:
    """Tuples whose third field is one of ``titles.page_title``; too short ones pass."""
    keyed = _once(tuples, "_title", field(TITLE_FIELD))
    known = written(titles.select(F.col("page_title").alias("_title"), F.lit(True).alias("_known")).distinct(), "titles")
    marked = lookup_join(keyed, known, ["_title"], "left", _spread(tuples), stored=False, **limits)
    return marked.where(F.col("_known") | _lacks(TITLE_FIELD)).drop("_title", "_known")


def _spread(tuples: DataFrame) -> list[str]:
    return [c for c in (*PLACE, "line_no", "pos") if c in tuples.columns]


def other_lines(lines: DataFrame) -> DataFrame:
    """Lines which are not inserts, but for empty ones."""
    return lines.where(~is_insert(F.col("value")) & (F.col("value") != ""))


def rebuild_inserts(tuples: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """``(*place, value)``: one insert line from the tuples that are left of each line.

    A group is what remains of one input line. Lines without tuples do not come back.
    """
    in_order = F.array_sort(F.collect_list(F.struct("pos", "tuple")))
    values = F.array_join(F.transform(in_order, lambda t: t["tuple"]), ",")
    line = F.concat(F.lit("INSERT INTO `"), "table", F.lit("` VALUES "), "_values", F.lit(";"))
    rebuilt = tuples.groupBy(*place, "table").agg(text_to_bytes(values).alias("_values"))
    return rebuilt.select(*place, line.alias("value"))


def rebuild_dump(lines: DataFrame, tuples: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """``(*place, value)``: the dump with the surviving tuples, all other lines unchanged."""
    return other_lines(lines).select(*place, "value").unionByName(rebuild_inserts(tuples, place))


def with_chunk(numbered: DataFrame, chunk_size: int) -> DataFrame:
    """Add ``chunk``, counting ``chunk_size`` input lines each; size 0 makes one chunk."""
    chunk = F.call_function("div", "line_no", F.lit(chunk_size)) if chunk_size > 0 else F.lit(0)
    return numbered.withColumn("chunk", chunk.cast("bigint"))


def skip_chunks(chunked: DataFrame, skip: int) -> DataFrame:
    return chunked.where(F.col("chunk") >= skip)


def tuple_ids(tuples: DataFrame) -> DataFrame:
    """Ids of the tuples with their place, duplicates kept."""
    keyed = tuples if "id" in tuples.columns else require_int_key(tuples)
    return keyed.drop("table", "tuple", "fields")
