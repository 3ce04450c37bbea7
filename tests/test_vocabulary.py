"""The vocabulary stage beside Spark's count vectoriser, and saved with a pipeline."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import functions as F

from sentilode.functions.text import model_tokens
from sentilode.operators.stages import VocabularyLearner, count_model
from sentilode.session import materialize


@pytest.fixture(scope="module")
def tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return materialize(docs.select("doc_id", model_tokens(F.col("text")).alias("words")), "tokens")


@pytest.mark.parametrize("size, docs", [(1 << 18, 1), (300, 1), (300, 3), (7, 1)])
def test_same_counts_as_the_count_vectoriser(tokens, size, docs):
    ours = VocabularyLearner(inputCol="words", outputCol="tf", vocabSize=size, minDocs=docs).fit(tokens).vocabulary
    theirs = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=size, minDF=docs).fit(tokens).vocabulary
    cf = {r["w"]: r["n"] for r in tokens.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    assert [cf[t] for t in ours] == [cf[t] for t in theirs]
    # Above the last count, where no tie decides, the terms are the same; ours are in order of count and term.
    last = cf[ours[-1]]
    assert {t for t in ours if cf[t] > last} == {t for t in theirs if cf[t] > last}
    assert ours == sorted(ours, key=lambda t: (-cf[t], t))
    if size == 1 << 18:
        assert set(ours) == set(theirs) == set(cf)


def test_ties_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(["b", "a", "c", "a"],), (["c", None, "b"],), (None,), ([],)], "words array<string>")
    assert VocabularyLearner(inputCol="words", outputCol="tf", vocabSize=2).fit(rows).vocabulary == ["a", "b"]
    assert VocabularyLearner(inputCol="words", outputCol="tf", minDocs=2).fit(rows).vocabulary == ["b", "c"]
    with pytest.raises(ValueError, match="no terms"):
        VocabularyLearner(inputCol="words", outputCol="tf").fit(rows.limit(0))


def test_saved_with_the_pipeline(tokens, tmp_path):
    estimator = Pipeline(stages=[VocabularyLearner(inputCol="words", outputCol="tf", vocabSize=50)])
    estimator.write().save(str(tmp_path / "estimator"))
    model = Pipeline.load(str(tmp_path / "estimator")).fit(tokens)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    vectors = lambda m: {r["doc_id"]: r["tf"] for r in m.transform(tokens).collect()}
    assert vectors(again) == vectors(model) and again.stages[0].vocabulary == model.stages[0].vocabulary


WORDS = ["day", "a b", "\u00e9\U0001f600", "\r", "\u2028", ".", "last", ""]


@pytest.mark.parametrize("terms", [["one"], [""], WORDS, [*WORDS, "x\ny"], [*WORDS, "x\0y"], ["x\0y", "x\ny", "z"]])
def test_model_of_any_terms(spark, terms):
    ours, theirs = (
        make(terms, "words", "tf") for make in (lambda *a: count_model(spark, *a), CountVectorizerModel.from_vocabulary)
    )
    assert ours.vocabulary == theirs.vocabulary == terms
    told = [{p.name: m.getOrDefault(p) for p in m.params if m.isDefined(p)} for m in (ours, theirs)]
    assert told[0] == told[1] and told[0]["vocabSize"] == len(terms)
    rows = spark.createDataFrame([([*terms, "day"],)], "words array<string>")
    assert ours.transform(rows).first()["tf"] == theirs.transform(rows).first()["tf"]


def test_terms_are_sent_in_few_calls(spark, tokens, monkeypatch):
    """Setting the terms one by one in the JVM took two minutes for 262,144 of them."""
    def one_by_one(*a):
        raise AssertionError("a call for each term")

    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", staticmethod(one_by_one))
    model = VocabularyLearner(inputCol="words", outputCol="tf", vocabSize=50).fit(tokens)
    assert len(model.vocabulary) == 50
