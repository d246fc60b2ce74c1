"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import attach, written


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root``, written: the smallest vertex that each vertex of ``edges(a, b)`` can reach.

    Every vertex is tied to the smallest of its neighbours, first the larger neighbours and
    then the smaller ones, until nothing changes; each pass is two aggregates and two joins over
    the edges, whose number never grows. The minima of a vertex with very many edges are
    partial aggregates, written and joined like any lookup, with the edges of such a vertex in slices.
    """
    edges = written(_canonical(edges), "edges")
    state = _state(edges)
    while True:
        # Larger neighbours go to the smallest one.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least-neighbours")
        large = attach(both.where("b > a"), least, ["a"], spread_by=["b"]).select(F.col("least").alias("a"), "b")
        large = written(_canonical(large), "large-star")
        # Then a vertex and its smaller neighbours go to the smallest of these.
        least = written(large.groupBy("b").agg(F.min("a").alias("least")), "least-below")
        small = attach(large, least, ["b"], spread_by=["a"]).select(F.col("least").alias("a"), F.col("a").alias("b"))
        edges = written(_canonical(small.unionByName(least.select(F.col("least").alias("a"), "b"))), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("vertex"), F.col("a").alias("root"))
    return written(roots.unionByName(edges.select(F.col("a").alias("vertex"), F.col("a").alias("root")).distinct()), "components")


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
