"""Pipelines, their training, evaluation and cross-validation with MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    NGram,
    Normalizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from sentilode.operators.features import VOCABULARY_SIZE, bigram_terms, bigram_weights, with_counts
from sentilode.operators.grower import EntryForest
from sentilode.operators.stages import LemmaLearner, Lemmatizer, TextCleaner, ValueIndexer, VocabularyLearner
from sentilode.session import materialize


def classifier(name: str, seed: int = 42) -> Estimator:
    """The classifiers with their fixed settings."""
    if name == "naive_bayes":
        return NaiveBayes(smoothing=1.0, modelType="multinomial")
    if name == "linear_svc":
        return LinearSVC(maxIter=10, regParam=0.1)
    if name == "logistic_regression":
        return LogisticRegression(maxIter=10)
    if name == "logistic_elasticnet":
        return LogisticRegression(maxIter=100, regParam=0.3, elasticNetParam=0.8)
    if name == "random_forest":
        return EntryForest(featuresCol="indexedFeatures", numTrees=10, seed=seed)
    raise ValueError(name)


def token_stages(
    lexicon: Sequence[str] | str, text: str = "text", expand_contractions: bool = False
) -> list:
    """text -> tweet -> words -> filtered -> lemmatized.

    `lexicon` is the path of a table of lemmas, with which those of the words met in training are learned, or a short list of them.
    """
    columns = {"inputCol": "filtered", "outputCol": "lemmatized"}
    lemmas = (
        LemmaLearner(lexiconPath=lexicon, **columns)
        if isinstance(lexicon, str)
        else Lemmatizer(lexicon=list(lexicon), **columns)
    )
    stop = StopWordsRemover(inputCol="words", outputCol="filtered", locale="en")
    stop.setStopWords(StopWordsRemover.loadDefaultStopWords("english"))
    return [
        TextCleaner(inputCol=text, outputCol="tweet", expandContractions=expand_contractions),
        Tokenizer(inputCol="tweet", outputCol="words"),
        stop,
        lemmas,
    ]


def feature_stages(kind: str = "count", vocabulary_size: int = VOCABULARY_SIZE) -> list:
    """lemmatized -> tf -> features; `hash` goes through n-grams of one word to hashed counts."""
    weights = IDF(inputCol="tf", outputCol="features")
    if kind == "hash":
        return [
            NGram(n=1, inputCol="lemmatized", outputCol="ngrams"),
            HashingTF(inputCol="ngrams", outputCol="tf"),
            weights,
        ]
    return [
        VocabularyLearner(inputCol="lemmatized", outputCol="tf", vocabSize=vocabulary_size),
        weights,
    ]


def model_stages(name: str) -> list:
    indexer = [ValueIndexer(inputCol="features", outputCol="indexedFeatures", handleInvalid="keep")]
    return (indexer if name == "random_forest" else []) + [classifier(name)]


def pipeline(
    name: str,
    lexicon: Sequence[str] | str = (),
    features: str = "count",
    text: str = "text",
    expand_contractions: bool = False,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> Pipeline:
    return Pipeline(
        stages=token_stages(lexicon, text, expand_contractions)
        + feature_stages(features, vocabulary_size)
        + model_stages(name)
    )


def transform(stages: Sequence[Transformer], rows: DataFrame) -> DataFrame:
    for stage in stages:
        rows = stage.transform(rows)
    return rows


def learn_tokens(stages: Sequence, rows: DataFrame, *keep: str) -> tuple[list[Transformer], DataFrame]:
    """(the stages, learned; keep and lemmatized of `rows`, written). Texts are cleaned and cut once, lemmas are found once."""
    *plain, last = stages
    if isinstance(last, LemmaLearner):
        rows = materialize(transform(plain, rows).select(*keep, last.getInputCol()), "filtered-tokens")
        last = last.fit(rows)
        tokens = last.transform(rows)
    else:
        tokens = transform(stages, rows)
    return [*plain, last], materialize(tokens.select(*keep, "lemmatized"), "training-tokens")


def train(estimator: Pipeline, rows: DataFrame, corpus: DataFrame | None = None) -> PipelineModel:
    """Fit on `rows`. The stages before the features run once, not in every pass of the others.

    With `corpus` the features are learned from those rows, such as all rows
    before the split, and only the classifier from `rows`.
    """
    stages = estimator.getStages()
    learned_from = next((i for i, s in enumerate(stages) if isinstance(s, (VocabularyLearner, NGram))), None)
    if learned_from is None:
        raise ValueError("the pipeline must count terms (VocabularyLearner) or hash n-grams (NGram, HashingTF)")
    features, model = stages[learned_from:-1], stages[-1]
    fixed, tokens = learn_tokens(stages[:learned_from], rows, "label")
    if corpus is None:
        return PipelineModel(
            stages=[*fixed, *Pipeline(stages=[*features, model]).fit(tokens).stages]
        )
    wide = materialize(transform(fixed, corpus).select("lemmatized"), "corpus-tokens")
    learned = Pipeline(stages=features).fit(wide)
    return PipelineModel(stages=[*fixed, *learned.stages, model.fit(learned.transform(tokens))])


def cross_validate(
    rows: DataFrame,
    lexicon: Sequence[str] | str,
    fold: str,
    folds: int = 5,
    smoothings: Sequence[float] = (0.0, 0.5, 1.0),
    features: str = "hash",
    text: str = "text",
    expand_contractions: bool = True,
    parallelism: int = 3,
) -> tuple[CrossValidatorModel, list]:
    """Choose the smoothing by mean accuracy over given folds, and refit on all rows.

    What no row changes (n-grams, hashed counts) is found once and written; what is learned, such as weights, is learned
    once a fold and serves the whole grid. Gives the model on tokens and the token stages to run before it.
    """
    fixed, tokens = learn_tokens(token_stages(lexicon, text, expand_contractions), rows, "label", fold)
    bayes = classifier("naive_bayes")
    grid = ParamGridBuilder().addGrid(bayes.smoothing, list(smoothings)).build()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    stages = feature_stages(features)
    plain = list(takewhile(lambda stage: isinstance(stage, Transformer), stages))
    learned = Pipeline(stages=stages[len(plain):])
    if plain:
        tokens = materialize(transform(plain, tokens).select("label", fold, plain[-1].getOutputCol()), "fold-counts")
    if not tokens.filter(~F.coalesce(F.col(fold).between(0, folds - 1), F.lit(False))).isEmpty():
        raise ValueError(f"folds must be numbered from 0 to {folds - 1}")

    def judged(f: int) -> list[float]:
        seen, held = tokens.filter(F.col(fold) != f), tokens.filter(F.col(fold) == f)
        if seen.isEmpty() or held.isEmpty():
            raise ValueError(f"fold {f} leaves no rows to learn from or to judge")
        weights = learned.fit(seen)
        seen, held = (weights.transform(part).select("label", bayes.getFeaturesCol()) for part in (seen, held))
        return [evaluator.evaluate(bayes.fit(seen, setting).transform(held)) for setting in grid]

    with ThreadPool(min(parallelism, folds)) as pool:
        scores = pool.map(inheritable_thread_target(tokens.sparkSession)(judged), range(folds))
    means, spread = np.mean(scores, axis=0), np.std(scores, axis=0)
    weights = learned.fit(tokens)
    best = bayes.fit(weights.transform(tokens), grid[int(np.argmax(means))])
    found = CrossValidatorModel(
        PipelineModel(stages=[*plain, *weights.stages, best]), avgMetrics=list(means), stdMetrics=list(spread)
    )
    for name, value in {
        "estimator": Pipeline(stages=[*stages, bayes]), "estimatorParamMaps": grid, "evaluator": evaluator,
        "numFolds": folds, "foldCol": fold,
    }.items():
        found.set(found.getParam(name), value)
    return found, fixed


def bigram_vectors(docs: DataFrame, text: Column, *keep: str, size: int = 5000) -> DataFrame:
    """(keep, features): 1- and 2-gram weights of length 1, learned from all of `docs`."""
    grams = materialize(docs.select(*keep, bigram_terms(text).alias("grams")), "grams")
    learned = bigram_weights(with_counts(grams, F.col("grams")), size).orderBy("term").collect()  # `size` rows
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in learned], "grams", "tf")
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in learned]), inputCol="tf", outputCol="weights"
    )
    unit = Normalizer(p=2.0, inputCol="weights", outputCol="features")
    return transform([counter, scale, unit], grams).select(*keep, "features")


def out_of_fold(rows: DataFrame, estimator: Estimator, fold: str, folds: int) -> DataFrame:
    """Every row of (features, label, fold) predicted once, by a model that did not see its fold."""
    rows = materialize(rows, "fold-rows")
    parts = []
    for f in range(folds):
        model = estimator.fit(rows.filter(F.col(fold) != f))
        parts.append(model.transform(rows.filter(F.col(fold) == f)).select(*rows.columns, "prediction"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
