"""MLlib pipelines, cross-validation and stream scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from sentilode.checks import sql as S
from sentilode.checks.bayes import GRID, report_sql
from sentilode.checks.registry import query
from sentilode.checks.tables import LEXICON_COUNT, documents, labelled, load
from sentilode.checks.weights import bigram_ctes
from sentilode.functions import text as tx
from sentilode.operators import features, metrics, sampling
from sentilode.operators.features import with_counts
from sentilode.operators.scale import lookup_join
from sentilode.operators.stages import VocabularyLearner
from sentilode.plans import training
from sentilode.session import materialize, scratch_path
from sentilode.sources import messages as msg, results as res
from sentilode.streaming.score import write_scored

def lexicon(spark, sf_dir) -> str:
    """The path of a table of all words that the documents use often."""
    path = scratch_path(spark, "lexicon")
    totals = features.term_totals(documents(spark, sf_dir), tx.model_tokens(F.col("text")))
    common = totals.filter(F.col("cf") >= LEXICON_COUNT)
    common.select(F.col("term").alias("lemma")).write.parquet(path)
    return path


def _split(spark, sf_dir):
    return sampling.split(labelled(spark, sf_dir), 0.8, "doc_id")


def _model(spark, sf_dir, name: str, rows, **options):
    return training.train(training.pipeline(name, lexicon(spark, sf_dir), **options), rows)


def _predictions(spark, sf_dir, name: str):
    """The held-out rows, scored by a pipeline that saw the others."""
    train, test = _split(spark, sf_dir)
    return _model(spark, sf_dir, name, train).transform(test).select(
        "doc_id", "label", F.col("prediction").cast("int").alias("prediction")
    )


# The same pipeline in SQL: lemmas of the tokens, naive Bayes on their weights.
LEMMAS = (
    f"{S.LABELLED}, "
    f"doc_toks AS (SELECT doc_id, {S.model_tokens('text')} AS toks FROM documents), "
    "doc_terms AS (SELECT doc_id, term, count(*) AS tf FROM "
    "(SELECT doc_id, unnest(toks) AS term FROM doc_toks) GROUP BY doc_id, term), "
    f"lexicon AS (SELECT 'n' AS pos, term AS lemma FROM doc_terms GROUP BY term "
    f"HAVING sum(tf) >= {LEXICON_COUNT})"
)
TRAIN = f"train AS (SELECT 0 AS run, doc_id, label FROM labelled WHERE {S.in_fraction('doc_id', 0.8)})"
HELD_OUT = (
    f"WITH RECURSIVE {LEMMAS}, nouns AS (SELECT DISTINCT term, 'n' AS pos FROM doc_terms), "
    f"{S.lemma_ctes('nouns', 'lexicon')}, "
    "pairs AS (SELECT doc_id, lemma AS term, sum(tf) AS tf FROM doc_terms JOIN lemma_of USING (term) GROUP BY doc_id, lemma), "
    f"{TRAIN}, "
    f"test AS (SELECT 0 AS run, doc_id, label FROM labelled WHERE NOT ({S.in_fraction('doc_id', 0.8)})), "
    f"{S.naive_bayes()}"
)


@query("nb_ml", f"{HELD_OUT} SELECT doc_id, label, prediction FROM pred")
def nb_ml(spark, sf_dir):
    return _predictions(spark, sf_dir, "naive_bayes")


@query("train_eval", f"{HELD_OUT}, {report_sql('pred')}")
def train_eval(spark, sf_dir):
    counts = metrics.outcome_counts(_predictions(spark, sf_dir, "naive_bayes"))
    return metrics.classification_report(counts)


@query("linear_svc")
def linear_svc(spark, sf_dir):
    return _predictions(spark, sf_dir, "linear_svc")


@query("logistic_regression")
def logistic_regression(spark, sf_dir):
    return _predictions(spark, sf_dir, "logistic_regression")


@query("logistic_elasticnet")
def logistic_elasticnet(spark, sf_dir):
    return _predictions(spark, sf_dir, "logistic_elasticnet")


@query("random_forest")
def random_forest(spark, sf_dir):
    return _predictions(spark, sf_dir, "random_forest")


def _margins_agree(spark, sf_dir, name: str):
    """(doc_id, label, agrees): whether the model's margin is the sum over a document's terms, taken by joins.

    Weights come from the relational operators, which SQL checks, and only the coefficients from the model. So this checks
    features, scoring and that no row is lost; the solver is checked against an independent one in the tests.
    """
    train, test = _split(spark, sf_dir)
    model = _model(spark, sf_dir, name, train)
    fixed, counter, linear = model.stages[:4], model.stages[4], model.stages[-1]
    counts = [
        materialize(with_counts(training.transform(fixed, rows), F.col("lemmatized"), "doc_id", "label"), "margin-counts")
        for rows in (train, test)
    ]
    weights = materialize(features.idf(features.term_stats(counts[0]), counts[0].count()), "margin-idf")
    coefficients = spark.createDataFrame(
        list(zip(counter.vocabulary, linear.coefficients.toArray().tolist())), "term string, coefficient double"
    )
    sums = (
        lookup_join(features.tfidf(counts[1], weights, "doc_id"), materialize(coefficients, "coefficients"), "term", "inner")
        .groupBy("doc_id")
        .agg(F.sum(F.col("weight") * F.col("coefficient")).alias("margin"))
    )
    scored = model.transform(test).select("doc_id", "label", vector_to_array("rawPrediction").alias("raw"))
    margin = F.coalesce("margin", F.lit(0.0)) + linear.intercept
    near = F.abs(margin - F.col("raw")[1]) <= 1e-6 * (1 + F.abs(margin))
    return scored.join(sums, "doc_id", "left").select("doc_id", "label", near.alias("agrees"))


ALL_AGREE = (
    f"WITH {S.LABELLED} SELECT doc_id, label, true AS agrees FROM labelled WHERE NOT ({S.in_fraction('doc_id', 0.8)})"
)


@query("linear_svc_margins", ALL_AGREE)
def linear_svc_margins(spark, sf_dir):
    return _margins_agree(spark, sf_dir, "linear_svc")


@query("logistic_regression_margins", ALL_AGREE)
def logistic_regression_margins(spark, sf_dir):
    return _margins_agree(spark, sf_dir, "logistic_regression")


@query("logistic_elasticnet_margins", ALL_AGREE)
def logistic_elasticnet_margins(spark, sf_dir):
    return _margins_agree(spark, sf_dir, "logistic_elasticnet")


def _tokens(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.model_tokens(F.col("text")).alias("lemmatized"))


def _entries(vectors, column: str):
    """(doc_id, index, value) of the stored entries of a sparse vector."""
    v = F.unwrap_udt(column)
    return vectors.select("doc_id", v.alias("v")).select(
        "doc_id", F.inline(F.arrays_zip("v.indices", "v.values"))
    ).toDF("doc_id", "index", "value")


BUCKETS = 1 << 18


@query(
    "hashing_tf",
    f"WITH {S.pairs(S.model_tokens('text'), 'documents')}, {S.murmur3('pairs', BUCKETS)} "
    "SELECT doc_id, bucket, CAST(sum(tf) AS BIGINT) AS tf FROM pairs JOIN hashed USING (term) GROUP BY doc_id, bucket",
)
def hashing_tf(spark, sf_dir):
    hashed = HashingTF(inputCol="lemmatized", outputCol="tf").transform(_tokens(spark, sf_dir))
    return _entries(hashed, "tf").select(
        "doc_id", F.col("index").alias("bucket"), F.col("value").cast("bigint").alias("tf")
    )


@query(
    "vocabulary_stage",
    f"WITH {S.pairs(S.model_tokens('text'), 'documents')}, stats AS (SELECT term, sum(tf) AS cf FROM pairs GROUP BY term), "
    "vocabulary AS (SELECT term, row_number() OVER (ORDER BY cf DESC, term) - 1 AS place FROM stats "
    "ORDER BY cf DESC, term LIMIT 5000) "
    "SELECT doc_id, count(*) AS n_terms, md5(string_agg(CAST(place AS VARCHAR) || ':' || "
    "CAST(CAST(tf AS BIGINT) AS VARCHAR), ',' ORDER BY place)) AS counts FROM pairs JOIN vocabulary USING (term) GROUP BY doc_id",
)
def vocabulary_stage(spark, sf_dir):
    """The count vectors of all documents over the 5000 most frequent terms; a document's row has the digest of its vector."""
    tokens = materialize(_tokens(spark, sf_dir).select("doc_id", "lemmatized"), "stage-tokens")
    model = VocabularyLearner(inputCol="lemmatized", outputCol="tf", vocabSize=5000).fit(tokens)
    v = F.unwrap_udt("tf")
    cells = F.zip_with(v["indices"], v["values"], lambda i, n: F.concat_ws(":", i, n.cast("bigint")))
    return (
        model.transform(tokens)
        .select("doc_id", F.size(v["indices"]).cast("bigint").alias("n_terms"), F.md5(F.concat_ws(",", cells)).alias("counts"))
        .filter("n_terms > 0")
    )


@query(
    "vector_indexer",
    f"WITH {S.pairs(S.model_tokens('text'), 'documents')}, "
    "w AS (SELECT term, count(DISTINCT tf) AS kinds, "
    "ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1)) AS idf FROM pairs GROUP BY term) "
    "SELECT doc_id, term, round(CASE WHEN kinds < 20 THEN dense_rank() OVER (PARTITION BY term ORDER BY tf) "
    "ELSE tf * idf END, 6) AS value FROM pairs JOIN w USING (term) WHERE idf <> 0",
)
def vector_indexer(spark, sf_dir):
    """Features with few values become category numbers; the others keep their weight."""
    counted = materialize(with_counts(_tokens(spark, sf_dir), F.col("lemmatized"), "doc_id"), "indexer-counts")
    stats = materialize(features.term_stats(counted), "indexer-stats")
    found = features.category_indexed(counted, stats, counted.count(), 20, "doc_id")
    return found.select("doc_id", "term", F.round("value", 6).alias("value"))


@query(
    "cv_best",
    f"WITH RECURSIVE {LEMMAS}, "
    f"toks AS (SELECT doc_id, {S.expanded_tokens('text')} AS toks FROM labelled), "
    "terms AS (SELECT doc_id, term, count(*) AS tf FROM "
    "(SELECT doc_id, unnest(toks) AS term FROM toks) GROUP BY doc_id, term), "
    "nouns AS (SELECT DISTINCT term, 'n' AS pos FROM terms), "
    f"{S.lemma_ctes('nouns', 'lexicon')}, lemmas AS (SELECT DISTINCT lemma AS term FROM lemma_of), "
    f"{S.murmur3('lemmas', BUCKETS)}, "
    "pairs AS (SELECT doc_id, bucket AS term, sum(tf) AS tf FROM terms JOIN lemma_of USING (term) "
    "JOIN hashed ON hashed.term = lemma GROUP BY doc_id, bucket), "
    f"{S.FOLDS}, {S.naive_bayes(GRID, BUCKETS)}, "
    "per_fold AS (SELECT s, run, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a FROM pred GROUP BY s, run), "
    "mean AS (SELECT s AS smoothing, avg(a) AS accuracy FROM per_fold GROUP BY s) "
    "SELECT smoothing, round(accuracy, 6) AS accuracy, "
    "row_number() OVER (ORDER BY round(accuracy, 12) DESC, smoothing) = 1 AS best FROM mean",
)
def cv_best(spark, sf_dir):
    """(smoothing, accuracy, best) of the grid, on hashed features."""
    rows = labelled(spark, sf_dir)
    folds = sampling.assign_folds(rows.select("doc_id", "label"), 5, "doc_id").select("doc_id", "fold")
    found, _ = training.cross_validate(rows.join(folds, "doc_id"), lexicon(spark, sf_dir), "fold")
    chosen = found.bestModel.stages[-1].getOrDefault("smoothing")
    grid = [p[next(k for k in p if k.name == "smoothing")] for p in found.getEstimatorParamMaps()]
    lines = [(float(s), round(float(a), 6), s == chosen) for s, a in zip(grid, found.avgMetrics)]
    return spark.createDataFrame(lines, "smoothing double, accuracy double, best boolean")


def _out_of_fold(spark, sf_dir, name: str):
    """Out-of-fold predictions on 1- and 2-gram weights that were learned from all rows."""
    rows = labelled(spark, sf_dir)
    folds = sampling.assign_folds(rows.select("doc_id", "label"), 5, "doc_id").select("doc_id", "fold")
    vectors = training.bigram_vectors(rows.join(folds, "doc_id"), F.col("text"), "doc_id", "label", "fold")
    return training.out_of_fold(vectors, training.classifier(name), "fold", 5).select(
        "doc_id", "label", "fold", F.col("prediction").cast("int").alias("prediction")
    )


@query(
    "oof_nb_bigram",
    f"WITH {S.LABELLED}, {bigram_ctes('labelled')}, pairs AS (SELECT doc_id, term, weight AS tf FROM unit), "
    f"{S.FOLDS}, {S.naive_bayes(buckets='(SELECT count(*) FROM kept)', weighted=True)} "
    "SELECT doc_id, label, run AS fold, prediction FROM pred",
)
def oof_nb_bigram(spark, sf_dir):
    return _out_of_fold(spark, sf_dir, "naive_bayes")


@query("oof_svc_bigram")
def oof_svc_bigram(spark, sf_dir):
    return _out_of_fold(spark, sf_dir, "linear_svc")


@query(
    "stream_score",
    f"WITH RECURSIVE {LEMMAS}, "
    "sent AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS k, text FROM conversations), "
    f"sent_toks AS (SELECT k, {S.model_tokens('text')} AS toks FROM sent), "
    "sent_terms AS (SELECT -1 - k AS doc_id, term, count(*) AS tf FROM "
    "(SELECT k, unnest(toks) AS term FROM sent_toks) GROUP BY k, term), "
    "all_terms AS (SELECT * FROM doc_terms UNION ALL SELECT * FROM sent_terms), "
    "nouns AS (SELECT DISTINCT term, 'n' AS pos FROM all_terms), "
    f"{S.lemma_ctes('nouns', 'lexicon')}, "
    "pairs AS (SELECT doc_id, lemma AS term, sum(tf) AS tf FROM all_terms JOIN lemma_of USING (term) GROUP BY doc_id, lemma), "
    "train AS (SELECT 0 AS run, doc_id, label FROM labelled), "
    "test AS (SELECT 0 AS run, -1 - k AS doc_id, 0 AS label FROM sent), "
    f"{S.naive_bayes()} "
    "SELECT CAST(k AS VARCHAR) AS key, text AS value, "
    "CASE WHEN prediction = 1 THEN 'positive' ELSE 'negative' END AS sentiment "
    "FROM sent JOIN pred ON pred.doc_id = -1 - k",
)
def stream_score(spark, sf_dir):
    """Save a pipeline, load it, and score all conversations as a stream of messages."""
    where = scratch_path(spark, "stream")
    res.save_model(
        _model(spark, sf_dir, "naive_bayes", labelled(spark, sf_dir)), f"{where}/model"
    )
    msg.publish(msg.messages(load(spark, sf_dir, "conversations"), ["conv_id", "turn"]), path=f"{where}/log")
    stream = msg.subscribe(spark, path=f"{where}/log")
    model = res.load_pipeline(f"{where}/model")
    write_scored(model, stream, f"{where}/results", f"{where}/progress", available_now=True).awaitTermination()
    return res.read_results(spark, f"{where}/results").select("key", "value", "sentiment")
