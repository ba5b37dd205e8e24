"""Connected components of a graph given as edges, all of it in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two columns of numbers, a and b, in either order, repeats allowed. Each
    round links every node's larger neighbours to its smallest one (a large star), then its
    smaller ones (a small star), until nothing changes: a number of rounds of the order of
    the logarithm of the longest path. A node with many edges is one row of minima and a
    join that adaptive execution can split.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(pairs.where("a > b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = written(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Tells sets of edges apart."""
    bits = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(bits), F.sum(F.shiftright(bits, 24))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    larger = both.where("b > a").join(low, "a")
    return larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    others = edges.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(low.select("a", F.col("low").alias("b"))).distinct()
