"""Readers for labelled corpora and for messages to replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilode.functions.labels import recode_label
from sentilode.sources import quoted

# The columns of the labelled corpus file, which has no header.
CORPUS_SCHEMA = "target int, ids bigint, date string, flag string, user string, text string"


def read_corpus(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """The labelled CSV without header; no pass over the file to find the types.

    `multi_line` reads line breaks inside quotes, in byte ranges by all cores (sources.quoted), at the price of a second pass.
    """
    if multi_line:
        return quoted.read_csv(spark, path, CORPUS_SCHEMA, encoding)
    return (
        spark.read.schema(CORPUS_SCHEMA)
        .option("header", False)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )


def read_corpus_latin1(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_corpus(spark, path, encoding="ISO-8859-1", multi_line=multi_line)


def read_messages_csv(
    spark: SparkSession, path: str, column: str = "text", multi_line: bool = False
) -> DataFrame:
    """A CSV with header, of which one column is kept; `multi_line` as in read_corpus."""
    if multi_line:
        return quoted.read_csv(spark, path).select(column)
    return spark.read.option("header", True).option("escape", '"').csv(path).select(column)


def project_labelled(corpus: DataFrame, target: str = "target", text: str = "text") -> DataFrame:
    """(label, tweet) with the label recoded."""
    return corpus.select(recode_label(F.col(target)).alias("label"), F.col(text).alias("tweet"))


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))
