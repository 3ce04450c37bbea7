"""The offset ledger of a stream: which offsets each batch has brought into the results, and whether each message is there once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sentilode.session import materialize, passing_tables

PLACE = ("topic", "partition")
STRETCH_SCHEMA = "topic string, partition int, first bigint, last bigint, times bigint"
LEDGER_SCHEMA = f"{STRETCH_SCHEMA}, batch_id bigint"
# A partition's offsets are swept in blocks of 2 to this power, so no window holds a partition whole.
BLOCK_BITS = 20


def with_offsets(messages: DataFrame, topic: str, partitions: int) -> DataFrame:
    """Deal keyed messages to the partitions of a log in turn, with the place that a broker would give them.

    The key must be the running index from 0; a message that was not sent leaves a gap.
    """
    at = F.col("key").cast("string").cast("bigint")
    return messages.select(
        F.lit(topic).alias("topic"),
        F.pmod(at, F.lit(partitions)).cast("int").alias("partition"),
        F.expr(f"CAST(CAST(key AS STRING) AS BIGINT) div {partitions}").alias("offset"),
        *[c for c in messages.columns if c not in (*PLACE, "offset")],
    )


def intervals(rows: DataFrame) -> DataFrame:
    """(topic, partition, first, last, times): maximal stretches of offsets that the rows hold equally often.

    A row without topic, partition or offset has no place in a log and is passed over. No rows give no stretches.
    """
    placed = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*PLACE, "offset")]))
    return _segments(_bounds(placed, F.col("offset"), F.col("offset"), times=F.lit(1)), ["times"])


def record(rows: DataFrame, path: str, batch_id: int) -> None:
    """Note the offsets of one batch; the folder of its id is overwritten, as that of its results is."""
    with passing_tables(rows.sparkSession):
        intervals(rows).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, first, last, times, batch_id) of all batches; the folder must be there."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def audit(ledger: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(topic, partition, first, last, times, finding): every offset, in maximal stretches that were read equally often.

    `expected` has (topic, partition, first, last), the offsets that the log holds; without it these are the
    offsets from the first to the last one read of each partition. The finding is `once`, `repeated` (by several batches or
    within one), `gap` (expected, never read) or `unexpected` (read, but outside). Logs with transactions or compaction have
    offsets without a message: they are gaps here. A stretch whose end lies before its begin is empty.
    """
    if expected is None:
        expected = ledger.groupBy(*PLACE).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    events = _bounds(ledger, F.col("first"), F.col("last"), times=F.col("times"), expected=F.lit(0)).unionByName(
        _bounds(expected, F.col("first"), F.col("last"), times=F.lit(0), expected=F.lit(1))
    )
    finding = (
        F.when(F.col("expected") == 0, "unexpected")
        .when(F.col("times") == 0, "gap")
        .when(F.col("times") == 1, "once")
        .otherwise("repeated")
    )
    # Expected stretches may meet or overlap; their number says nothing.
    return _segments(events, ["times", "expected"]).select(*PLACE, "first", "last", "times", finding.alias("finding"))


def _bounds(df: DataFrame, first, last, **counts) -> DataFrame:
    """(topic, partition, at, counts): what begins at an offset, and what has ended before it, as a change of each count."""
    begin = F.struct(first.alias("at"), *[c.cast("bigint").alias(n) for n, c in counts.items()])
    end = F.struct((last + 1).alias("at"), *[(-c).cast("bigint").alias(n) for n, c in counts.items()])
    whole = df.filter(first <= last)
    return whole.select(*PLACE, F.inline(F.array(begin, end)))


def _segments(changes: DataFrame, counts: Sequence[str]) -> DataFrame:
    """(topic, partition, first, last, counts) between one change and the next, where any count is not 0.

    The running sums go over the blocks of a partition first, one row each, then over the changes within a block.
    """
    block = [*PLACE, "_block"]
    changed = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in counts])
    points = materialize(
        changes.groupBy(*PLACE, "at")
        .agg(*[F.sum(c).alias(c) for c in counts])
        .filter(changed)
        .withColumn("_block", F.shiftright("at", BLOCK_BITS)),
        "offset-changes",
    )
    blocks_in_order = Window.partitionBy(*PLACE).orderBy("_block")
    earlier = blocks_in_order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        points.groupBy(*block)
        .agg(F.min("at").alias("_start"), *[F.sum(c).alias(f"_all_{c}") for c in counts])
        .select(
            *block,
            F.lead("_start").over(blocks_in_order).alias("_next"),
            *[F.coalesce(F.sum(f"_all_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in counts],
        )
    )
    in_order = Window.partitionBy(*block).orderBy("at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        points.join(blocks, block)
        .select(
            *PLACE,
            F.col("at").alias("first"),
            (F.coalesce(F.lead("at").over(in_order), F.col("_next")) - 1).alias("last"),
            *[(F.col(f"_before_{c}") + F.sum(c).over(so_far)).alias(c) for c in counts],
        )
        .filter(changed)
    )
