"""Session settings and tables kept in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def build_session(app: str = "sentilode", **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for the dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="sentilode-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one table; everything of one application lies in one folder."""
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_root(spark)}/sentilode-{app}/{name}-{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders, on any file system that Spark can reach."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are written to the shared folder inside go when the block ends, as for one micro-batch of a stream."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        remove(spark, *paths)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application has written to the shared folder.

    Call it when no result is read any more: results are read from these tables.
    """
    remove(spark, f"{checkpoint_root(spark)}/sentilode-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimiser the real size of the table for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, for sessions whose workers cannot import it; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sentilode-package-")) / "sentilode.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
