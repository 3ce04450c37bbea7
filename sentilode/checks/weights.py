"""Vocabulary, term counts and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentilode.checks import sql as S
from sentilode.checks.registry import query
from sentilode.checks.tables import (
    counted_documents, document_terms, documents, load,
)
from sentilode.functions import patterns as P
from sentilode.operators import features, sampling
from sentilode.session import materialize

PAIRS = S.pairs(S.model_tokens("text"), "documents")
STATS = "stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM pairs GROUP BY term)"


@query("term_counts", f"WITH {PAIRS} SELECT doc_id, term, tf FROM pairs")
def term_counts(spark, sf_dir):
    return features.term_rows(counted_documents(spark, sf_dir), "doc_id").filter("term is not null")


@query("vocabulary", f"WITH {PAIRS}, {STATS} SELECT term, df, cf FROM stats ORDER BY cf DESC, term LIMIT 5000")
def vocabulary(spark, sf_dir):
    return features.vocabulary(document_terms(spark, sf_dir), 5000)


@query(
    "idf",
    f"WITH {PAIRS}, {STATS} SELECT term, df, "
    "round(ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1)), 6) AS idf FROM stats",
)
def idf(spark, sf_dir):
    weights = features.idf(document_terms(spark, sf_dir), load(spark, sf_dir, "documents").count())
    return weights.withColumn("idf", F.round("idf", 6))


def _tfidf_sql(learn: str) -> str:
    return (
        f"WITH {PAIRS}, learn AS (SELECT doc_id FROM documents WHERE {learn}), "
        "w AS (SELECT term, ln(((SELECT count(*) FROM learn) + 1.0) / (count(*) + 1)) AS idf "
        "FROM pairs JOIN learn USING (doc_id) GROUP BY term) "
        "SELECT doc_id, term, tf, round(tf * idf, 6) AS weight FROM pairs JOIN w USING (term)"
    )


def _tfidf(spark, sf_dir, whole: bool):
    """(doc_id, term, tf, weight) of all terms of all documents, learned from four fifths of them or from all."""
    counted = materialize(counted_documents(spark, sf_dir), "counted")
    learn = counted if whole else sampling.split(counted, 0.8, "doc_id")[0]
    weights = materialize(features.idf(features.term_stats(learn), learn.count()), "idf")
    return features.tfidf(counted, weights, "doc_id").withColumn("weight", F.round("weight", 6))


@query("tfidf", _tfidf_sql(S.in_fraction("doc_id", 0.8)))
def tfidf(spark, sf_dir):
    return _tfidf(spark, sf_dir, whole=False)


@query("tfidf_corpus_scope", _tfidf_sql("true"))
def tfidf_corpus_scope(spark, sf_dir):
    return _tfidf(spark, sf_dir, whole=True)


def bigram_ctes(docs: str) -> str:
    """kept(term, idf) and unit(doc_id, term, weight) of a relation with doc_id and text."""
    return (
        f"words AS (SELECT doc_id, regexp_extract_all(lower(text), {S.quoted(P.VECTOR_WORD)}, 1) AS k FROM {docs}), "
        "grams AS (SELECT doc_id, unnest(list_concat(k, list_transform(range(1, len(k)), "
        "lambda i: k[i] || ' ' || k[i + 1]))) AS term FROM words), "
        "counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term), "
        f"kept AS (SELECT term, ln(((SELECT count(*) FROM {docs}) + 1.0) / (count(*) + 1)) + 1 AS idf "
        "FROM counts GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000), "
        "w AS (SELECT doc_id, term, tf * idf AS w FROM counts JOIN kept USING (term)), "
        "unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"
    )


@query(
    "tfidf_bigram_l2",
    f"WITH {bigram_ctes('documents')} SELECT doc_id, term, round(weight, 6) AS weight FROM unit",
)
def tfidf_bigram_l2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return features.tfidf_bigrams_l2(docs, "doc_id", F.col("text")).withColumn("weight", F.round("weight", 6))
