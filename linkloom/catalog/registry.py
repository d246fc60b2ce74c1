"""Registry of queries: a function over the derived inputs, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.catalog.inputs import Inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``make(inputs)`` as query ``name``."""

    def add(make: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: make(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return add
