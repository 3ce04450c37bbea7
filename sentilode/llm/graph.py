"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sentilode.session import materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of (a, b); the component is its smallest node.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until nothing changes: each step hangs the
    neighbours of a node under the smallest of them, so that long chains halve. Each step is written, so a lost executor
    costs no more than one. Minima are summed up before the shuffle; a node with many edges is a skewed join key,
    which adaptive execution splits.
    """
    now = materialize(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    before = _summary(now)
    while True:
        large = materialize(_star(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), large=True), name)
        small = materialize(_star(large, large=False), name)
        after = _summary(small)
        if after == before:
            break
        now, before = small, after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _summary(edges: DataFrame) -> tuple:
    """Number of edges, sum of their ends and of their hashes: equal for equal sets, and for no others but by a 64-bit chance."""
    numbers = [F.col("a"), F.col("b"), F.xxhash64("a", "b")]
    return tuple(edges.agg(F.count("*"), *[F.sum(x.cast("decimal(38,0)")) for x in numbers]).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b, after one step. `edges` has both directions for a large step, a > b for a small one."""
    lowest = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    joined = edges.join(lowest, F.col("a") == F.col("n"))
    if large:
        found = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
    return found.filter(F.col("a") != F.col("b")).distinct()
