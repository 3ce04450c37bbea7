"""A results table that stays readable: folders of batches, merged by ranges under a manifest of live folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilode.session import remove
from sentilode.sources.results import RESULT_SCHEMA, arrival, snapshot

TABLE_SCHEMA = f"{RESULT_SCHEMA}, batch_id bigint"
# Names that begin with an underscore are passed over by readers that know only the folders of batches.
MANIFEST = "_manifest"
RANGES = "_ranges"
# Rows per merged file: some hundred megabytes of short messages.
FILE_ROWS = 2_000_000


@dataclass(frozen=True)
class Merged:
    """One merged folder: the batches first to last, and how many rows they have."""

    first: int
    last: int
    rows: int
    folder: str


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _version(spark: SparkSession, path: str) -> int:
    versions = [int(n.removeprefix("v")) for n in _names(spark, f"{path}/{MANIFEST}") if n.startswith("v")]
    return max(versions, default=0)


def manifest(spark: SparkSession, path: str) -> list[Merged]:
    """The merged folders of the latest version, in order of their batches."""
    version = _version(spark, path)
    if not version:
        return []
    rows = spark.read.schema("first bigint, last bigint, rows bigint, folder string").json(f"{path}/{MANIFEST}/v{version}")
    return sorted((Merged(**r.asDict()) for r in rows.collect()), key=lambda m: m.first)  # one row per merged folder


def batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches whose folders a query has finished."""
    found = sorted(int(n.removeprefix("batch_id=")) for n in _names(spark, path) if n.startswith("batch_id="))
    return [b for b in found if "_SUCCESS" in _names(spark, f"{path}/batch_id={b}")]


def _publish(spark: SparkSession, path: str, version: int, live: list[Merged]) -> None:
    """A version appears whole or not at all, and once: a second writer of it fails."""
    draft = f"{path}/{MANIFEST}/_draft-{spark.sparkContext.applicationId}-{version}"
    spark.createDataFrame([(m.first, m.last, m.rows, m.folder) for m in live], "first bigint, last bigint, rows bigint, folder string") \
        .coalesce(1).write.mode("overwrite").json(draft)
    source, fs = _fs(spark, draft)
    target, _ = _fs(spark, f"{path}/{MANIFEST}/v{version}")
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"version {version} of the manifest of {path} was written by another compaction")


def compact(spark: SparkSession, path: str, keep: int = 1, file_rows: int = FILE_ROWS) -> list[Merged]:
    """Merge the finished batches since the last compaction, but the latest `keep`, into one folder, and publish it.

    A stream can only run its latest batch again, so `keep` of at least 1 leaves that to the stream. Rows are range-partitioned and
    sorted in order of arrival, so each file has a narrow range of batches in its statistics. Nothing is deleted:
    readers of an older version still find its folders, until `vacuum`. Run one compaction at a time; of two at once one
    fails and leaves the table as it was. With nothing to merge, nothing is written. Batches without rows are merged like others.
    """
    if keep < 1:
        raise ValueError("the latest batch may be run again: keep at least 1")
    version, live = _version(spark, path), manifest(spark, path)
    done = live[-1].last if live else -1
    ready = [b for b in batches(spark, path) if b > done][:-keep]
    if not ready:
        return live
    rows = _batch_rows(spark, path, ready)
    n = rows.count()
    name = f"{RANGES}/{ready[0]}-{ready[-1]}-v{version + 1}"
    parts = -(-n // file_rows) or 1
    by = arrival()
    rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(f"{path}/{name}")
    live = [*live, Merged(ready[0], ready[-1], n, name)]
    _publish(spark, path, version + 1, live)
    return live


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of batches that are in a merged one, and older versions; says how many batches went.

    Run it when no reader of an older version is at work.
    """
    version, live = _version(spark, path), manifest(spark, path)
    done = live[-1].last if live else -1
    gone = [b for b in batches(spark, path) if b <= done]
    remove(spark, *[f"{path}/batch_id={b}" for b in gone], *[f"{path}/{MANIFEST}/v{v}" for v in range(1, version)])
    return len(gone)


def _batch_rows(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in numbers])


def _rows(spark: SparkSession, path: str, live: list[Merged], numbers: list[int]) -> DataFrame:
    parts = []
    if live:
        parts.append(spark.read.schema(TABLE_SCHEMA).parquet(*[f"{path}/{m.folder}" for m in live]))
    if numbers:
        parts.append(_batch_rows(spark, path, numbers))
    if not parts:
        return spark.createDataFrame([], TABLE_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Every result once: the merged folders of the latest version, and the finished batches after them."""
    live = manifest(spark, path)
    done = live[-1].last if live else -1
    return _rows(spark, path, live, [b for b in batches(spark, path) if b > done])


def latest(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The last `n` results, last first; reads the folders that hold them and no others.

    Batches that are not merged are few; of the merged folders the counts in the manifest tell which are needed.
    """
    live = manifest(spark, path)
    done = live[-1].last if live else -1
    numbers = [b for b in batches(spark, path) if b > done]
    have = _batch_rows(spark, path, numbers).count() if numbers else 0
    needed: list[Merged] = []
    for folder in reversed(live):
        if have >= n:
            break
        needed.append(folder)
        have += folder.rows
    return snapshot(_rows(spark, path, needed[::-1], numbers), latest=n)


def page(rows: DataFrame, size: int, after: tuple[int, str | None] | None = None) -> DataFrame:
    """The `size` results that follow the one with this (batch_id, key), in order of arrival; the first ones without it.

    Only batches from that one on are read: the filter reaches the statistics of the files. A null key comes first in its batch, then
    those that are no number, in order of text.
    """
    by = arrival()
    if after is not None:
        batch, key = after
        at = [F.lit(batch).cast("bigint"), F.lit(key).cast("string").try_cast("bigint"), F.lit(key).cast("string")]
        rows = rows.filter(F.col("batch_id") >= batch).filter(_later(by, at))
    return rows.orderBy(*by).limit(size)


def _later(columns: list[Column], at: list[Column]) -> Column:
    """Whether a row comes after a place, column by column, nulls first."""
    later = F.lit(False)
    for column, value in zip(reversed(columns), reversed(at)):
        greater = F.coalesce(column > value, column.isNotNull() & value.isNull())
        later = greater | (column.eqNullSafe(value) & later)
    return later
