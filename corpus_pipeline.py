"""A corpus pipeline of five operators: each stage's rows are written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilode.llm import decontaminate, mixing, near, tokens, toxicity
from sentilode.llm.common import load
from sentilode.llm.queries import public_vocabulary
from sentilode.llm.registry import query, ship
from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

# No stage with hashed features, sketches or a tokenizer can be told in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier rejects go.

    A null or empty text is scored as an empty one; a text of any length is scored whole; equal texts share their fate; an empty table, or
    one without labelled rows of both labels, loses nothing by it; columns of any other name stay as they are.
    """
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays; rows without an id stay.

    Null and empty texts are linked with nothing and stay, long texts are compared whole, rows that repeat an id stay or go
    together, an empty table stays empty, and all columns are kept.
    """
    ship(spark)
    found = near.near_duplicates(docs)
    gone = materialize(found.filter(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    small = measured_bytes(gone) <= BROADCAST_BYTES
    return docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a test item go.

    Null and empty texts and items match nothing, long texts are searched whole, repeated rows go together, an empty table on either
    side loses nothing, and all columns are kept.
    """
    ship(spark)
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, by its source.

    A null source is one of its own, null and empty texts have no words, ties go by id, size and digest, repeated rows are taken each, an empty table
    stays empty, and all columns are kept.
    """
    ship(spark)
    mixed = mixing.mix(docs).filter(F.col("copies") > 0)
    copies = mixed.select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    return copies.select("doc.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files in the shared folder, and what these hold per document.

    A null text has the end's id alone, null ids come first, copies are written each, long texts are encoded whole, an empty table gives files
    without rows; other columns end here.
    """
    ship(spark)
    return tokens.round_trip(docs, public_vocabulary(), keep=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
