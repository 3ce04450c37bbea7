"""Samples, splits, folds and label codes that a key decides, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.operators.scale import lookup_join, ranked
from sentilode.session import materialize


def _digest(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def in_fraction(key: str, fraction: float) -> Column:
    """True for the rows whose key hashes into the first `fraction` of the hash range."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    if fraction == 1:
        return F.lit(True)
    return F.substring(_digest(key), 1, 8) < f"{int(fraction * 2**32):08x}"


def sample_fraction(
    df: DataFrame, fraction: float, key: str | None = None, seed: int | None = None
) -> DataFrame:
    """A Bernoulli sample, by key or by a given seed."""
    if key is not None:
        return df.filter(in_fraction(key, fraction))
    if seed is None:
        raise ValueError("give a key or a seed")
    return df.sample(fraction=fraction, seed=seed)


def sample_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """`n` rows without replacement: those whose keys have the smallest hashes.

    Rows are counted by the first 16 bits of the hash. All rows before the bin with the n-th row are taken, and of
    that bin, about a 65 536th of the table, the first by full hash and key. So no task sorts the sample.
    """
    head = F.conv(F.substring(_digest(key), 1, 4), 16, 10).cast("int")
    counts = df.groupBy(head.alias("bin")).agg(F.count("*").alias("n")).collect()  # 65 536 at most
    before = 0
    for row in sorted(counts, key=lambda r: (r["bin"] is not None, r["bin"])):
        if before + row["n"] >= n:
            break
        before += row["n"]
    else:
        return df
    edge = df.filter(head.eqNullSafe(F.lit(row["bin"]))).orderBy(_digest(key), F.col(key)).limit(n - before)
    if row["bin"] is None:
        return edge
    return df.filter(head.isNull() | (head < row["bin"])).unionByName(edge)


def split(
    df: DataFrame, fraction: float, key: str | None = None, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Two parts that together are the whole; the first gets about `fraction` of the rows.

    Prefer a key. With a seed the rows must come in the same parts each time
    they are read, as they do from files.
    """
    if key is not None:
        first = in_fraction(key, fraction)
        return df.filter(first), df.filter(~first)
    if seed is None:
        raise ValueError("give a key or a seed")
    a, b = df.randomSplit([fraction, 1 - fraction], seed)
    return a, b


def assign_folds(df: DataFrame, k: int, key: str, label: str = "label", name: str = "fold") -> DataFrame:
    """Stratified folds: the rows of each label, in key order, are dealt to folds 0..k-1."""
    numbered = ranked(df, [key], [label], "_nth")
    return numbered.withColumn(name, (F.col("_nth") % k).cast("int")).drop("_nth")


def encode_labels(df: DataFrame, label: str, name: str = "code") -> DataFrame:
    """Give each label its place (from 0) among the distinct labels in order."""
    codes = materialize(ranked(df.select(label).distinct(), [label], name=name), "label-codes")
    return lookup_join(df, codes, label)
