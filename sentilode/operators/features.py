"""Term counts, vocabularies and TF-IDF weights as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilode.functions.arrays import count_terms, let, ngrams
from sentilode.functions.text import vector_words
from sentilode.operators.scale import lookup_join, top_k
from sentilode.session import materialize

# Fixed value: the largest vocabulary a count vectoriser learns by default.
VOCABULARY_SIZE = 1 << 18


def with_counts(df: DataFrame, tokens: Column, *keep: str) -> DataFrame:
    """One row per document with its `terms`: array<struct<term, tf>>."""
    return df.select(*keep, count_terms(tokens).alias("terms"))


def term_rows(counted: DataFrame, *keep: str) -> DataFrame:
    """(keep, term, tf); a document without terms gives one row with nulls."""
    return counted.select(*keep, F.inline_outer("terms"))


def known_rows(counted: DataFrame, *keep: str) -> DataFrame:
    """(keep, term, tf) without documents that have no terms.

    For inline() the optimiser would add a filter on the size of the array,
    which counts the terms once more; so the outer form is taken and filtered.
    """
    return term_rows(counted, *keep).filter(F.col("term").isNotNull())


def term_stats(counted: DataFrame) -> DataFrame:
    """(term, df, cf): documents with the term, and its count in the corpus."""
    return (
        known_rows(counted)
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    )


def term_totals(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, cf): how often each token occurs in all rows, without counts per row. A null or empty array has none, a null token is no term."""
    terms = df.select(F.explode_outer(tokens).alias("term")).filter(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("cf"))


def vocabulary(stats: DataFrame, size: int = VOCABULARY_SIZE, min_df: int = 1) -> DataFrame:
    """The `size` most frequent terms; among equal counts the first in term order."""
    return top_k(stats.filter(F.col("df") >= min_df), size, F.col("cf"), [F.desc("cf"), F.col("term")])


def idf_weight(df_count: Column, documents: Column) -> Column:
    return F.log((documents + 1) / (df_count + 1))


def idf(stats: DataFrame, documents: int) -> DataFrame:
    return stats.select("term", "df", idf_weight(F.col("df"), F.lit(documents)).alias("idf"))


def tfidf(counted: DataFrame, weights: DataFrame, *keep: str) -> DataFrame:
    """(keep, term, tf, weight) for the terms that `weights` (term, idf) knows; a column `df` there tells the frequent ones."""
    rows = known_rows(counted, *keep)
    counts = weights.filter(F.col("df").isNotNull()).select("term", F.col("df").alias("n")) if "df" in weights.columns else None
    return lookup_join(rows, weights.select("term", "idf"), "term", "inner", counts=counts).select(
        *keep, "term", "tf", (F.col("tf") * F.col("idf")).alias("weight")
    )


def category_indexed(counted: DataFrame, stats: DataFrame, documents: int, most: int, *keep: str) -> DataFrame:
    """(keep, term, value): the weights, but of terms with at most `most` values the number of the value, from 0 for a document without the term.

    As VectorIndexer has it over the vectors of all weights, without a cell for each term in a task: the values of a term are
    its distinct counts, found by group-bys. Terms of weight zero are left out, as a sparse vector does.
    """
    values = known_rows(counted).select("term", "tf").distinct().groupBy("term").agg(F.sort_array(F.collect_list("tf")).alias("values"))
    numbered = values.select("term", F.when(F.size("values") < most, F.col("values")).alias("values"))
    table = materialize(idf(stats, documents).filter(F.col("idf") != 0).join(numbered, "term"), "category-values")
    rows = lookup_join(known_rows(counted, *keep), table, "term", "inner")
    value = F.coalesce(F.array_position("values", F.col("tf")).cast("double"), F.col("tf") * F.col("idf"))
    return rows.select(*keep, "term", value.alias("value"))


def bigram_terms(text: Column) -> Column:
    """The words of a text and its pairs of neighbours."""
    return let(vector_words(text), lambda words: F.concat(words, ngrams(words, 2)))


def bigram_weights(counted: DataFrame, size: int = 5000) -> DataFrame:
    """(term, idf) of the `size` most frequent terms, written once."""
    stats = materialize(term_stats(counted), "gram-stats")
    weight = idf_weight(F.col("df"), F.lit(counted.count())) + 1
    return materialize(vocabulary(stats, size).select("term", weight.alias("idf")), "gram-idf")


def tfidf_bigrams_l2(docs: DataFrame, key: str, text: Column, size: int = 5000) -> DataFrame:
    """(key, term, weight): 1- and 2-grams, the `size` most frequent, rows of length 1."""
    counted = materialize(with_counts(docs, bigram_terms(text), key), "gram-counts")
    weights = bigram_weights(counted, size)
    of_doc = Window.partitionBy(key)  # at most `size` rows
    return tfidf(counted, weights, key).select(
        key, "term", (F.col("weight") / F.sqrt(F.sum(F.col("weight") ** 2).over(of_doc))).alias("weight")
    )
