"""Text functions that work on bytes, so that names which are not valid UTF-8 survive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of pages that are not articles.
INTERNAL_TITLE = r"^(Help|Draft|Category|File|User|Talk|(S|s)pecial|Wikipedia|Template)(_talk)?:"

INTEGER = r"^[+-]?[0-9]+\z"


def byte_slice(value: Column, start: Column, length: Column) -> Column:
    """``length`` bytes from the 1-based byte ``start``."""
    return F.substring(value.cast("binary"), start, length).cast("string")


def chomp(value: Column) -> Column:
    """Drop one carriage return at the end of a line."""
    return F.when(
        value.endswith("\r"), byte_slice(value, F.lit(1), F.octet_length(value) - 1)
    ).otherwise(value)


def strip(value: Column) -> Column:
    """Drop white space on both sides."""
    return F.btrim(value, F.lit(" \t\n\r\x0b\x0c"))


def parse_int(value: Column) -> Column:
    """Optional sign and digits only, else null; also null beyond 64 bits."""
    # The argument is named once, as it may be a long expression. No match gives "".
    return F.regexp_extract(value, INTEGER, 0).try_cast("bigint")


def is_internal(title: Column) -> Column:
    # The colon test is a plain byte search and spares most titles the pattern.
    return title.contains(":") & title.rlike(INTERNAL_TITLE)


def natural_key(path: Column) -> Column:
    """A text that sorts like ``path`` with its runs of digits compared as numbers of up to twenty digits."""
    padded = F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})", "$1")


def bytes_to_text(value: Column) -> Column:
    """One character per byte, so that patterns neither see nor damage broken UTF-8."""
    return F.decode(value.cast("binary"), "ISO-8859-1")


def text_to_bytes(value: Column) -> Column:
    """Inverse of :func:`bytes_to_text`."""
    return F.encode(value, "ISO-8859-1").cast("string")
