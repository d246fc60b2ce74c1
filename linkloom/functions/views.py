"""Decoding of view-log lines: ``project title... count bytes``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import byte_slice, parse_int


def project_of(line: Column) -> Column:
    return F.substring_index(line, " ", 1)


def last_field(line: Column) -> Column:
    return F.substring_index(line, " ", -1)


def count_field(line: Column) -> Column:
    return F.substring_index(F.substring_index(line, " ", -2), " ", 1)


def _title_length(line: Column) -> Column:
    """Bytes between the project and the last two fields; negative below four fields."""
    tail = F.substring_index(line, " ", -2)
    return F.octet_length(line) - F.octet_length(project_of(line)) - F.octet_length(tail) - 2


def title_of(line: Column) -> Column:
    """Everything between project and count, inner spaces kept."""
    return byte_slice(line, F.octet_length(project_of(line)) + 2, _title_length(line))


def is_decodable(line: Column) -> Column:
    return (_title_length(line) >= 0) & parse_int(count_field(line)).isNotNull()
