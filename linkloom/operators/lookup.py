"""Joins of a large side, in which a key may be very frequent, to a lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from linkloom.runtime import written

# A lookup is broadcast when its rows, measured, stay below this size.
BROADCAST_BYTES = 128 << 20
# Keys with more rows than this are spread over several tasks, one per this many rows.
HOT_ROWS = 1_000_000
# The table of such keys is broadcast up to this measured size, whatever the limit for the lookup.
HOT_BYTES = 32 << 20

_ROW_OVERHEAD = 48


def stored_bytes(table: DataFrame) -> int:
    """Memory a broadcast of ``table`` takes, from its row count and the lengths of its values."""
    width = F.lit(_ROW_OVERHEAD + 8 * len(table.columns))
    for f in table.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            width = width + 8 * F.coalesce(F.size(f.name), F.lit(0))
    return table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    counted: DataFrame | None = None,
    stored: bool = True,
    hot: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``facts`` joined with ``lookup`` on ``on``; ``how`` is inner, left, left_semi or left_anti.

    A lookup whose measured size is small is broadcast and ``facts`` is not shuffled.
    A larger one is joined by key. Keys that hold more than ``hot_rows`` facts are then
    cut into slices: their lookup rows are repeated once per slice, their facts go to the
    slice given by a hash of ``spread_by``. Pass stored columns which tell the rows of a
    key apart, so that the slice of a row is the same when a task is run again.
    ``lookup`` is read twice and should be a file or written table. So are ``facts`` if
    keys must be counted; ``counted`` may name a cheaper table with at least their keys,
    ``hot`` may be the result of :func:`frequent_keys`, and facts that are not ``stored``
    are written before they are counted.
    """
    on = list(on)
    if stored_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), on, how)

    slices = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("bigint")
    if hot is None:
        if counted is None and not stored:
            facts = written(facts, "facts")
        hot = frequent_keys(facts if counted is None else counted, on, hot_rows)
    hot = hot.select(*on, slices.alias("_slices"))
    if stored_bytes(hot) <= HOT_BYTES:
        hot = F.broadcast(hot)
    slices = F.coalesce(F.col("_slices"), F.lit(1).cast("bigint"))
    spread = F.xxhash64(*(spread_by or facts.columns))
    # A missing key matches nothing; spreading such rows keeps them out of one task.
    slice_of = F.when(_any_null(on), spread).otherwise(F.pmod(spread, slices))
    left = facts.join(hot, on, "left").withColumn("_slice", slice_of).drop("_slices")
    right = (
        lookup.join(hot, on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        .drop("_slices")
    )
    return left.join(right, [*on, "_slice"], how).drop("_slice")


def frequent_keys(facts: DataFrame, on: Sequence[str], rows: int) -> DataFrame:
    """``(*on, _rows)``, written: keys with more than ``rows`` rows."""
    counts = facts.where(~_any_null(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return written(counts.where(F.col("_rows") > rows), "frequent-keys")


def _any_null(columns: Sequence[str]):
    return reduce(or_, (F.col(c).isNull() for c in columns))
