"""Patterns and field functions of ``INSERT INTO`` dump lines.

Lines are matched in their one-character-per-byte form. All repetitions that can
get long are possessive: they neither backtrack nor recurse, whatever the line length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import text_to_bytes

_QUOTED = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_TUPLE = rf"\((?:[^'()\\]++|\\.|{_QUOTED})*+\)"
_FIELD = rf"(?:[^',\\]++|\\.|{_QUOTED})*+"

IS_INSERT = r"(?s)INSERT INTO `.*` VALUES \(.*\);"
INSERT_HEAD = r"(?s)INSERT INTO `(.*?)` VALUES \("
# \G ties every match to the end of the one before, so other text between tuples ends the list.
NEXT_TUPLE = rf"(?s)\G(?:^|\s*+,\s*+){_TUPLE}"
LIST_END = r"^\s*+;"
NEXT_FIELD = rf"(?s)(?:^|,)({_FIELD})"


def is_insert(line: Column) -> Column:
    return line.contains("INSERT INTO `") & line.rlike(IS_INSERT)


def insert_parts(line: Column) -> Column:
    """``struct(table, body)``; the body starts at the first parenthesis after VALUES."""
    head = F.regexp_substr(line, F.lit(INSERT_HEAD))
    table = F.regexp_extract(head, INSERT_HEAD, 1)
    start = F.instr(line, head) + F.length(head) - 1
    return F.struct(table.alias("table"), F.substring(line, start, F.length(line)).alias("body"))


def tuple_list(body: Column) -> Column:
    """Tuples of the body of an insert line, each with the separator before it; see :func:`bare_tuple`."""
    return F.regexp_extract_all(body, F.lit(NEXT_TUPLE), 0)


def bare_tuple(item: Column) -> Column:
    """An item of :func:`tuple_list` from its opening parenthesis on."""
    return F.ltrim(item, F.lit(", \t\n\x0b\f\r"))


def is_complete(body: Column, tuples: Column) -> Column:
    """Whether nothing but white space is left between the tuples and the closing semicolon."""
    return F.substring(body, F.length(F.array_join(tuples, "")) + 1, F.length(body)).rlike(LIST_END)


def raw_fields(tuple_text: Column) -> Column:
    """Fields of a tuple as written; commas inside quotes do not separate."""
    inner = F.substring(tuple_text, F.lit(2), F.length(tuple_text) - 2)
    return F.regexp_extract_all(inner, F.lit(NEXT_FIELD), 1)


def _unescape(text: Column) -> Column:
    # Escaped backslashes step aside first, so that the rest can be replaced in any order.
    text = F.replace(text, F.lit("\\\\"), F.lit("\ue000"))
    text = F.replace(text, F.lit("''"), F.lit("'"))
    for letter, char in (("0", "\x00"), ("n", "\n"), ("r", "\r"), ("t", "\t"), ("Z", "\x1a")):
        text = F.replace(text, F.lit("\\" + letter), F.lit(char))
    text = F.regexp_replace(text, r"\\(.)", "$1")
    return F.replace(text, F.lit("\ue000"), F.lit("\\"))


def field_value(field: Column) -> Column:
    """The text that a written field stands for; an unquoted NULL is null."""
    quoted = (F.length(field) > 1) & field.startswith("'") & field.endswith("'")
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    inner = F.when(inner.contains("\\") | inner.contains("''"), _unescape(inner)).otherwise(inner)
    return F.when(quoted, text_to_bytes(inner)).when(field != "NULL", text_to_bytes(field))
