"""Inputs that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilode.functions.text import model_tokens
from sentilode.operators.features import term_stats, with_counts
from sentilode.operators.scale import spread
from sentilode.session import materialize

# A word seen this often counts as a lemma in the lexicon that the queries derive.
LEXICON_COUNT = 3


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text)"""
    return spread(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, text)"""
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id").select(
        "doc_id", "label", "text"
    )


def decorated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): every cleaning step has something to do in every row."""
    key = F.col("doc_id").cast("string")
    text = F.concat(
        F.lit("@user"), key, F.lit(" "), F.col("text"), F.lit(" http://ex.org/"), key,
        F.lit(" www.a.b don't Can't"), F.lit("❤\U0001f600"),
    )
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


def corpus_lexicon(spark: SparkSession, stats: DataFrame) -> DataFrame:
    """(pos, lemma): the words of the corpus seen often, for every part of speech."""
    common = stats.filter(F.col("cf") >= LEXICON_COUNT)
    return common.select(
        F.explode(F.array(*map(F.lit, "nvar"))).alias("pos"), F.col("term").alias("lemma")
    )


def counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, terms) of all documents."""
    return with_counts(documents(spark, sf_dir), model_tokens(F.col("text")), "doc_id")


def counted_labelled(df: DataFrame, *keep: str) -> DataFrame:
    """(keep, terms) of labelled documents, written once for the passes over it."""
    return materialize(with_counts(df, model_tokens(F.col("text")), *keep), "counted")


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, df, cf) of all documents, written once."""
    return materialize(term_stats(counted_documents(spark, sf_dir)), "document-terms")
