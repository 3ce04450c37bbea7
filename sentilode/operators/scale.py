"""Ranks, top-k and joins that hold when one key has a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from sentilode.session import materialize

# A table is broadcast only if it was measured and found to be no larger than this.
BROADCAST_BYTES = 128 * 1024 * 1024
# At most this many keys are treated as hot in a join whose table is too large to broadcast.
HOT_KEYS = 10_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out by key if the input has fewer parts than the session has cores.

    For small or unsplittable files before work that is heavy per row. A large
    input has parts enough and is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def measured_bytes(table: DataFrame, array_bytes: int | None = None) -> int:
    """The size of a table's values in memory, from one aggregate over it.

    `array_bytes` is the size of a row's array columns if all rows have the same.
    """

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 24
        if isinstance(field.dataType, T.ArrayType) and array_bytes is not None:
            return F.lit(0)
        if isinstance(field.dataType, T.ArrayType):
            return F.length(F.to_json(F.struct(field.name))) + 24
        return F.lit(16)

    row = reduce(lambda a, b: a + b, [width(f) for f in table.schema.fields], F.lit(32 + (array_bytes or 0)))
    return table.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0]


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    array_bytes: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join a fact table with a table that has one row per key.

    A table of measured size within `max_bytes` is broadcast. Beyond it, the
    most frequent keys are joined by broadcasting their rows alone, and only
    the rest of the facts is shuffled, so no task gets a hot key. The table is
    read to measure it, and the facts more than once beyond the bound, so both
    should be written tables if they are costly. `counts` (key, n) tells how many facts
    a key has, one row per key, about right and written, if that is known; else they are counted.
    """
    if measured_bytes(table, array_bytes) <= max_bytes:
        return facts.join(F.broadcast(table), key, how)
    if counts is None:
        counts = materialize(
            facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), "key-counts"
        )
    hot = materialize(top_k(counts, HOT_KEYS, F.col("n"), [F.desc("n"), F.col(key)]).select(key), "hot-keys")
    hot = F.broadcast(hot)
    hot_table = table.join(hot, key, "left_semi")
    # Few rows can still be wide ones; beyond the bound adaptive execution splits the hot keys.
    if measured_bytes(hot_table, array_bytes) <= BROADCAST_BYTES:
        hot_table = F.broadcast(hot_table)
    parts = [
        facts.join(hot, key, "left_semi").join(hot_table, key, how),
        facts.filter(F.col(key).isNotNull())
        .join(hot, key, "left_anti")
        .join(table.join(hot, key, "left_anti"), key, how),
    ]
    if how == "left":
        parts.append(facts.filter(F.col(key).isNull()).join(hot_table, key, how))
    return reduce(DataFrame.unionByName, parts)


def top_k(
    df: DataFrame,
    k: int,
    key: Column,
    order: Sequence[Column],
    largest: bool = True,
) -> DataFrame:
    """The first `k` rows in `order`, which must begin with the non-negative integer `key`.

    The rows are counted by the bit length of the key (at most 64 groups); the
    counts tell which power of two bounds the answer. The final top-k then
    sees little more than `k` rows in all, instead of `k` from every task.
    """
    bits = F.length(F.bin(key.cast("bigint")))
    found = df.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()
    seen = 0
    bound = None
    for row in sorted(found, key=lambda r: r["bits"], reverse=largest):
        seen += row["n"]
        if seen >= k:
            bound = row["bits"]
            break
    if bound is not None:
        df = df.filter(key >= (1 << bound - 1 if bound > 1 else 0) if largest else key < (1 << bound))
    return df.orderBy(*order).limit(k)


def ranked(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Dense row number from 0 in `order_by`, within `partition_by`.

    The same as row_number() over a window, but no window holds a whole group:
    the rows are range-partitioned on group and order, which also splits a hot
    group, and numbered by their place in the part plus the rows of earlier
    parts. The order must be unique within a group.
    """
    by = [*partition_by, *order_by]
    part = F.spark_partition_id()
    placed = materialize(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(
            "*",
            part.alias("_part"),
            (F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)).alias("_pos"),
        ),
        "ranked",
    )
    # One row per part and group that has rows in it.
    earlier = Window.partitionBy(*partition_by).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = (
        placed.groupBy("_part", *partition_by)
        .agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(
            F.col("_part").alias("_s_part"),
            *[F.col(c).alias(f"_s_{c}") for c in partition_by],
            "_first",
            "_before",
        )
    )
    if not partition_by:
        spans = F.broadcast(spans)  # one row per part
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in partition_by],
        F.col("_part") == F.col("_s_part"),
    )
    return placed.join(spans, same).select(
        *df.columns, (F.col("_before") + F.col("_pos") - F.col("_first")).alias(name)
    )
