"""Texts in chunks that a task can hold, and hashes counted across chunks.

Repeats are found in rounds. In each, a chunk (a few megabytes of whole texts, chosen by a hash of the id)
sends hashes or strings to buckets, a bucket compares what all chunks have sent, and answers each of them.
Of a chunk's texts, a batch sends a hash twice at most, so a passage that a third of all texts share costs a
bucket a few entries per chunk and not one per text. The shuffled texts are the same exchange in every round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sentilode.llm.common import slices, texts

# Text bytes of a chunk, text bytes of a task, and bytes of hashes that one bucket is meant to get.
CHUNK_BYTES = 4 << 20
TASK_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
BLOBS = "bucket int, chunk int, payload binary"

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """All bits of a hash spread over all others."""
    h = (h ^ (h >> np.uint64(32))) * _C
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """((doc_id, text, chunk) shuffled by chunk, text bytes). Rows of one id share a chunk."""
    rows = texts(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    spark = docs.sparkSession
    parts = max(-(-size // TASK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n_chunks = max(-(-size // CHUNK_BYTES), 4 * parts)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(int(n_chunks))).cast("int")
    return rows.withColumn("chunk", chunk).repartition(int(parts), "chunk"), size


class Corpus:
    """The texts of a batch as one array of bytes, with the bounds of each."""

    def __init__(self, column: pa.Array) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        column = column.cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        data = column.buffers()[2] if len(column) else None
        self.data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0]

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row]:self.bounds[row + 1]].tobytes()


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a chunk by id, null ids last, then by text: the same order in every round."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def pieces(table: pa.Table, most_bytes: int = 1 << 20) -> Iterator[tuple[int, pa.Table]]:
    """(first row, rows) of about `most_bytes` of text at a time, or one row."""
    lengths = np.diff(Corpus(table.column("text")).bounds)
    start = 0
    while start < table.num_rows:
        upto = np.searchsorted(np.cumsum(lengths[start:start + 100_000]), most_bytes)
        stop = min(table.num_rows, start + max(1, int(upto)))
        yield start, table.slice(start, stop - start)
        start = stop


def blobs(hashes: np.ndarray, buckets: np.ndarray, chunk: int) -> pa.RecordBatch:
    """A row per bucket with the distinct hashes that go there; those that occur again are there twice."""
    order = np.lexsort((hashes, buckets))
    h, b = hashes[order], buckets[order]
    if len(h) > 2:
        third = np.concatenate([[False, False], (h[2:] == h[:-2]) & (b[2:] == b[:-2])])
        h, b = h[~third], b[~third]
    firsts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    payload = [p.tobytes() for p in np.split(h, firsts[1:])] if len(b) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(b[firsts].astype(np.int32)), pa.array(np.full(len(firsts), chunk, np.int32)), pa.array(payload, pa.binary())],
        ["bucket", "chunk", "payload"],
    )


def send_hashes(
    rows: DataFrame, n_buckets: int, hashes: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """Blobs of what `hashes` finds in the texts of a batch: (hash, other hash that chooses the bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 << 20):
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
                h, other = hashes(batch.column("text").take(pa.array(own)))
                if len(h):
                    yield blobs(h, (other % np.uint64(n_buckets)).astype(np.int64), int(chunk[own[0]]))

    return rows.mapInArrow(run, BLOBS)


def _answer(table: pa.Table) -> pa.Table:
    payload = [np.frombuffer(p, np.uint64) for p in table.column("payload").to_pylist()]
    every, counts = np.unique(np.concatenate(payload), return_counts=True)
    repeated = every[counts > 1]
    chunks, answers = [], []
    for chunk, own in zip(table.column("chunk").to_pylist(), payload):
        own = np.unique(own)
        own = own[members(own, repeated)]
        if len(own):
            chunks.append(chunk)
            answers.append(own.tobytes())
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "payload": pa.array(answers, pa.binary())})


def repeated_hashes(sent: DataFrame) -> DataFrame:
    """(chunk, payload): of the hashes that a chunk has sent, those that occur at least twice in all chunks together.

    Hashes are equal if 64 bits and the bucket are, which an independent hash chooses.
    """
    return sent.groupBy("bucket").applyInArrow(_answer, "chunk int, payload binary")


def gathered(table: pa.Table) -> np.ndarray:
    """All hashes of the answers to one chunk, sorted."""
    found = [np.frombuffer(p, np.uint64) for p in table.column("payload").to_pylist()]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def members(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `of`."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values


def buckets_for(n_bytes: int) -> int:
    return int(max(16, -(-n_bytes // BUCKET_BYTES)))
