"""Side by side run of a registered query and its SQL."""

from __future__ import annotations

import contextlib
import io
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def checker(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


# Spark types and the type names of the checking engine.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, name, make, oracle, sf_dir, connection=None) -> tuple[int, float, str]:
    """Row count, Spark seconds and plan; raises if the query differs from its SQL."""
    began = time.perf_counter()
    df = make(spark, sf_dir)
    rows = df.collect()
    seconds = time.perf_counter() - began
    if oracle is not None:
        answer = (connection or checker(sf_dir)).execute(oracle)
        columns = [c[0] for c in answer.description]
        want = rows_of(columns, answer.fetchall())
        got = rows_of(df.columns, rows)
        assert sorted(columns) == sorted(df.columns), f"{name}: columns {df.columns}, SQL has {columns}"
        kinds = {c[0]: str(c[1]) for c in answer.description}
        spark_kinds = {n: TYPES[k] for n, k in df.dtypes}
        assert kinds == spark_kinds, f"{name}: types {spark_kinds}, SQL has {kinds}"
        if got != want:
            extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
            raise AssertionError(f"{name}: {got.total()} rows, SQL {want.total()}; extra {extra}; missing {missing}")
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        df.explain()
    return len(rows), seconds, plan.getvalue()


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from linkloom.runtime import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    session, failed = local_session(app="compare"), []
    link = checker(folder)
    for key, query in queries().items():
        if only and key not in only:
            continue
        try:
            count, took, _ = compare(session, key, query, oracle_sql().get(key), folder, link)
            print(f"{key:24} {count:8} rows {took:7.2f} s {'' if key in oracle_sql() else '(rows only)'}", flush=True)
        except Exception as error:
            failed.append(key)
            print(f"{key:24} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
    print("failed:", failed)
