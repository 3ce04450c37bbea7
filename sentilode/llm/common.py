"""Inputs, word patterns and part counts that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilode.operators.scale import spread

# Text bytes that one task of a text shuffle is meant to get.
TASK_BYTES = 24 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of all rows; a null text is empty, other columns are left behind."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def spread_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`texts`, dealt out over the cores if the input has fewer parts than these."""
    return spread(texts(docs, id_col, text_col), "doc_id")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def joined(batches: Iterable[pa.RecordBatch], least_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows with small batches put together until they have `least_bytes`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least_bytes:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def let_go() -> None:
    """Give the memory that a task has freed back to the system: workers live on and serve other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_parts(docs: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many parts the texts of (doc_id, text) take at `task_bytes` each; one aggregate over them."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return int(max(cores, -(-size // task_bytes)))


def slices(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most_bytes` at most, or of one row."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
