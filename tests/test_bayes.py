"""Relational naive Bayes against MLlib and against separate fits."""

from __future__ import annotations

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sentilode.checks import tables
from sentilode.functions.text import model_tokens
from sentilode.operators import bayes, features, sampling
from sentilode.session import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rows = tables.labelled(spark, SF_DIR)
    folds = sampling.assign_folds(rows.select("doc_id", "label"), 3, "doc_id").select("doc_id", "fold")
    tokens = rows.join(folds, "doc_id").select(
        "doc_id", "label", "fold", model_tokens(F.col("text")).alias("tokens")
    )
    return materialize(tokens, "rows")


@pytest.fixture(scope="module")
def counted(rows):
    return materialize(features.with_counts(rows, F.col("tokens"), "doc_id", "label", "fold"), "counted")


def raw_by_doc(scored):
    return {(r["doc_id"], r["smoothing"]): (list(r["raw"]), r["prediction"]) for r in scored.collect()}


@pytest.mark.parametrize("size", [1 << 18, 500])
def test_same_as_mllib(rows, counted, size):
    train, test = rows.filter("fold > 0"), rows.filter("fold = 0")
    model = Pipeline(
        stages=[
            CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=1 << 18),
            IDF(inputCol="tf", outputCol="features"),
            NaiveBayes(smoothing=1.0),
        ]
    ).fit(train)
    if size < 1 << 18:
        # A vocabulary cut is exact: only the most frequent terms, ties by term.
        small = bayes.fit(counted.filter("fold > 0"), vocabulary_size=size)
        stats = features.term_stats(counted.filter("fold > 0"))
        want = {r["term"] for r in features.vocabulary(stats, size).collect()}
        assert {r["term"] for r in small.terms.collect()} == want and len(want) == size
        return
    want = {
        (r["doc_id"], 1.0): (r["raw"], int(r["prediction"]))
        for r in model.transform(test)
        .select("doc_id", vector_to_array("rawPrediction").alias("raw"), "prediction")
        .collect()
    }
    got = raw_by_doc(bayes.fit(counted.filter("fold > 0")).score(counted.filter("fold = 0"), "doc_id"))
    assert got.keys() == want.keys()
    for key, (raw, prediction) in want.items():
        assert got[key][0] == pytest.approx(raw, rel=1e-9) and got[key][1] == prediction


@pytest.mark.parametrize("size", [1 << 18, 400])
def test_folds_at_once_are_the_separate_fits(counted, size):
    grid = (0.0, 1.0)
    at_once = bayes.fit(counted, smoothings=grid, fold="fold", folds=3, vocabulary_size=size)
    got = raw_by_doc(at_once.score(counted, "doc_id", "fold", view="fold"))
    for fold in range(3):
        alone = bayes.fit(counted.filter(F.col("fold") != fold), smoothings=grid, vocabulary_size=size)
        for key, (raw, prediction) in raw_by_doc(
            alone.score(counted.filter(F.col("fold") == fold), "doc_id")
        ).items():
            assert got[key][0] == pytest.approx(raw, rel=1e-9) and got[key][1] == prediction


def test_unknown_and_missing_terms(spark):
    train = spark.createDataFrame(
        [(1, 0, ["bad", "bad"]), (2, 1, ["good"]), (3, 1, ["good", "fine"])], "doc_id int, label int, t array<string>"
    )
    test = spark.createDataFrame([(7, ["never"]), (8, []), (9, ["bad"])], "doc_id int, t array<string>")
    model = bayes.fit(features.with_counts(train, F.col("t"), "doc_id", "label"), smoothings=(0.0, 1.0))
    got = raw_by_doc(model.score(features.with_counts(test, F.col("t"), "doc_id"), "doc_id"))
    prior = [math.log(2) - math.log(5), math.log(3) - math.log(5)]
    assert got[(7, 1.0)] == (pytest.approx(prior), 1) and got[(8, 1.0)] == (pytest.approx(prior), 1)
    assert got[(9, 0.0)][0][1] == -math.inf and got[(9, 0.0)][1] == 0
    assert {r["label"] for r in model.parameters().collect()} == {0, 1}


def test_corpus_scope(counted):
    train = counted.filter("fold > 0")
    model = bayes.fit(train, corpus=counted)
    idf = {r["term"]: r["idf"] for r in features.idf(features.term_stats(counted), counted.count()).collect()}
    got = {r["term"]: r["idf"] for r in model.parameters().filter("label = 0").collect()}
    assert got == pytest.approx(idf)


def test_corpus_scope_by_fold(counted):
    """With corpus-wide features, too, all folds at once are the separate fits."""
    at_once = bayes.fit(counted, fold="fold", folds=3, corpus=counted)
    got = raw_by_doc(at_once.score(counted, "doc_id", "fold", view="fold"))
    for fold in range(3):
        alone = bayes.fit(counted.filter(F.col("fold") != fold), corpus=counted)
        for key, (raw, prediction) in raw_by_doc(alone.score(counted.filter(F.col("fold") == fold), "doc_id")).items():
            assert got[key][0] == pytest.approx(raw, rel=1e-9) and got[key][1] == prediction


def test_other_labels_teach_nothing(spark):
    rows = [(k, k % 2, ["bad", "day"] if k % 2 else ["good", "day"]) for k in range(20)]
    more = rows + [(100 + k, 2, ["day", "odd"]) for k in range(10)] + [(200, None, ["day"])]
    make = lambda r: features.with_counts(spark.createDataFrame(r, "doc_id int, label int, t array<string>"), F.col("t"), "doc_id", "label")
    alone, mixed = (sorted(map(tuple, bayes.fit(make(r)).parameters().collect())) for r in (rows, more))
    assert alone == mixed


def test_bigrams_against_brute_force(spark):
    docs = spark.createDataFrame([(1, "aa bb aa x"), (2, "bb cc"), (3, "")], "doc_id int, text string")
    got = {(r[0], r[1]): r[2] for r in features.tfidf_bigrams_l2(docs, "doc_id", F.col("text"), 4).collect()}
    grams = {1: ["aa", "bb", "aa", "aa bb", "bb aa"], 2: ["bb", "cc", "bb cc"], 3: []}
    kept = ["aa", "bb", "aa bb", "bb aa"]
    want = {}
    for doc, found in grams.items():
        w = {}
        for term in kept:
            df = sum(term in g for g in grams.values())
            if term in found:
                w[term] = found.count(term) * (math.log(4 / (df + 1)) + 1)
        norm = math.sqrt(sum(v * v for v in w.values()))
        want |= {(doc, t): v / norm for t, v in w.items()}
    assert got == pytest.approx(want)
