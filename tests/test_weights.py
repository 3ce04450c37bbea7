"""The queries of term weights on tables of a few rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle import connect, difference
from sentilode.checks import models, tables
from sentilode.operators import features

DOCS = [(1, "apple pear apple"), (2, "pear plum"), (3, None), (4, ""), (5, "plum plum plum fig"), (6, "apple")]


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id bigint, text string").toPandas().to_parquet(tmp_path / "documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["tfidf", "tfidf_corpus_scope"])
def test_a_row_per_document_and_term(spark, sf_dir, name):
    found = contract.queries()[name](spark, sf_dir)
    assert sorted(found.columns) == ["doc_id", "term", "tf", "weight"]
    assert difference(found, contract.oracle_sql()[name], connect(sf_dir)) is None


def test_weights_of_the_whole_corpus(spark, sf_dir):
    found = contract.queries()["tfidf_corpus_scope"](spark, sf_dir).collect()
    documents = {"apple": 2, "pear": 2, "plum": 2, "fig": 1}
    want = {
        (k, term): (text.split().count(term), round(text.split().count(term) * math.log(7 / (documents[term] + 1)), 6))
        for k, text in DOCS if text for term in set(text.split())
    }
    assert {(r["doc_id"], r["term"]): (r["tf"], r["weight"]) for r in found} == want


def test_totals_without_counts_per_row(spark):
    """Those of the counted rows, with null and empty arrays and null tokens."""
    lines = [(1, ["a", "b", "a", None]), (2, ["b", "a"]), (3, None), (4, []), (5, [None]), (5, ["c", ""])]
    rows = spark.createDataFrame(lines, "doc_id bigint, toks array<string>")
    found = features.term_totals(rows, F.col("toks"))
    want = features.term_stats(features.with_counts(rows, F.col("toks"))).select("term", "cf")
    assert sorted(found.collect()) == sorted(want.collect())
    assert {r["term"]: r["cf"] for r in found.collect()} == {"a": 3, "b": 2, "c": 1, "": 1}


def test_the_lexicon_counts_no_rows(spark, tmp_path, monkeypatch):
    """Words of three occurrences in all documents, without a count per document."""
    lines = [(1, "apple apple pear"), (2, "apple pear the"), (3, None), (4, ""), (5, "plum plum the the"), (5, "plum pear")]
    spark.createDataFrame(lines, "doc_id bigint, text string").toPandas().to_parquet(tmp_path / "documents.parquet")
    for name in ("count_terms", "with_counts"):
        monkeypatch.setattr(features, name, None)
    monkeypatch.setattr(tables, "with_counts", None)
    found = spark.read.parquet(models.lexicon(spark, str(tmp_path))).collect()
    assert sorted(r["lemma"] for r in found) == ["apple", "pear", "plum"]


def test_category_numbers_as_the_vector_indexer_has_them(spark):
    """Beside Spark's own stage, with a term of one value, of many, in all documents, and rows without terms."""
    from pyspark.ml.feature import IDF, CountVectorizer, VectorIndexer
    from sentilode.operators import features

    texts = [["all"] + ["few"] * (k % 3) + ["many"] * k + ["once"] * (k == 4) for k in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, words array<string>")
    counter = CountVectorizer(inputCol="words", outputCol="tf").fit(df)
    weighted = IDF(inputCol="tf", outputCol="w").fit(counter.transform(df)).transform(counter.transform(df))
    indexed = VectorIndexer(inputCol="w", outputCol="out", maxCategories=4).fit(weighted).transform(weighted)
    want = {
        (r["k"], counter.vocabulary[i]): round(float(v), 9)
        for r in indexed.collect() for i, v in enumerate(r["out"].toArray()) if v
    }
    counted = features.with_counts(df, F.col("words"), "k")
    found = features.category_indexed(counted, features.term_stats(counted), 8, 4, "k").collect()
    assert {(r["k"], r["term"]): round(r["value"], 9) for r in found} == want


def test_vector_indexer_with_null_texts(spark, sf_dir):
    found = contract.queries()["vector_indexer"](spark, sf_dir)
    assert difference(found, contract.oracle_sql()["vector_indexer"], connect(sf_dir)) is None
