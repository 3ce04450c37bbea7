"""The keyed message log: publishing, reading and decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes, ranked
from sentilode.session import materialize

# The columns of a message.
MESSAGE_SCHEMA = "key binary, value binary"
PLACED_SCHEMA = f"topic string, partition int, offset bigint, {MESSAGE_SCHEMA}"


def sequence_key(df: DataFrame, order_by: Sequence[str], name: str = "key") -> DataFrame:
    """Add a dense running index from 0 as text."""
    return ranked(df, order_by, name=name).withColumn(name, F.col(name).cast("string"))


def file_sequence_key(df: DataFrame, name: str = "key") -> DataFrame:
    """Add the running index of each row in file order, for a DataFrame read straight from files.

    No row is shuffled unless there are too many blocks to broadcast. The rows are written with their place in their block,
    so that it stays the same when a task is run again; the rows of earlier
    blocks are added to it.
    """
    placed = materialize(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "file-rows",
    )
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("_file", "_block")
        .agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    blocks = materialize(blocks, "file-blocks")
    if measured_bytes(blocks) <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    return placed.join(blocks, ["_file", "_block"]).select(
        *df.columns, (F.col("_before") + F.col("_row") - F.col("_first")).cast("string").alias(name)
    )


def messages(
    df: DataFrame,
    order_by: Sequence[str] | None = None,
    text: str = "text",
    null_text: str | None = None,
) -> DataFrame:
    """(key binary, value binary): key is the running index of the row, value its text.

    The index follows `order_by`, or the order in the files `df` was read from.
    A row without text keeps its index and is not sent, unless `null_text` stands in for it.
    """
    if order_by:
        keyed = sequence_key(df.select(*order_by, text), order_by)
    else:
        keyed = file_sequence_key(df)
    value = F.col(text) if null_text is None else F.coalesce(text, F.lit(null_text))
    return keyed.filter(value.isNotNull()).select(
        F.col("key").cast("binary").alias("key"), value.cast("binary").alias("value")
    )


def publish(df: DataFrame, *, topic: str | None = None, servers: str | None = None, path: str | None = None):
    """Append messages to a topic, or to a folder of Parquet files that stands in for one."""
    if path is not None:
        df.write.mode("append").parquet(path)
        return
    (
        df.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def subscribe(
    spark: SparkSession,
    *,
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "earliest",
    files_per_trigger: int | None = None,
    offsets_per_trigger: int | None = None,
    schema: str = MESSAGE_SCHEMA,
) -> DataFrame:
    """The message log as a stream from its start; a checkpoint remembers how far a query got.

    The limits per trigger keep the first batches of a long log small. `schema` is that of a folder's files.
    """
    if path is not None:
        reader = spark.readStream.schema(schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(path)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.load()


def decode(df: DataFrame) -> DataFrame:
    """(key, value) as text; a null key passes."""
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
