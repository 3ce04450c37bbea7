"""What iterative solvers leave to check: the forest's votes by joins, and certificates of the linear models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilode.checks import sql as S
from sentilode.checks.models import ALL_AGREE, _entries, _model, _split
from sentilode.checks.registry import query
from sentilode.checks.tables import labelled
from sentilode.operators import certificate, forest
from sentilode.plans import training
from sentilode.session import materialize

# How far above the best possible objective a solver may stop, as a part of the objective of no coefficients. Ten steps of the support
# vector machine end well before its optimum.
ALLOWED = {"linear_svc": 0.5, "logistic_elasticnet": 0.01, "svc_bigram": 0.5}
# What is added to every coefficient to see that the objective then is another one.
MOVED = 0.5


@query("random_forest_votes", ALL_AGREE)
def random_forest_votes(spark, sf_dir):
    """(doc_id, label, agrees): whether a held-out row's votes, from the table of tree conditions, are those of the model."""
    train, test = _split(spark, sf_dir)
    model = _model(spark, sf_dir, "random_forest", train)
    told = model.transform(test).select(
        "doc_id", "label", "indexedFeatures", vector_to_array("rawPrediction").alias("raw"), "prediction"
    )
    told = materialize(told, "forest-scored")
    entries = _entries(told, "indexedFeatures").filter("value <> 0")
    found = forest.votes(entries, told, model.stages[-1]).select("doc_id", "votes")
    near = F.forall(F.zip_with("raw", "votes", lambda a, b: F.abs(a - b) <= 1e-6), lambda same: same)
    # Of equal votes the first class wins.
    first = F.array_position("votes", F.array_max("votes")) - 1
    # Votes within rounding of a tie may go either way.
    tied = F.abs(F.get("votes", F.lit(0)) - F.get("votes", F.lit(1))) <= 1e-6
    agrees = near & (tied | (first == F.col("prediction")))
    return told.join(found, "doc_id").select("doc_id", "label", agrees.alias("agrees"))


def _certified(spark: SparkSession, name: str, rows: DataFrame, linear, summary, penalty: float, **how) -> DataFrame:
    """(solver, n, objective_agrees, within_gap, moved_fails) of a model on its training rows (doc_id, label, features)."""
    rows = materialize(rows.select("doc_id", "label", "features"), "certified-rows")
    entries = materialize(_entries(rows, "features").filter("value <> 0"), "certified-entries")
    values = linear.coefficients.toArray().tolist()

    def certify(shift: float) -> certificate.Certificate:
        table = spark.createDataFrame([(k, v + shift) for k, v in enumerate(values)], "index int, coefficient double")
        return certificate.certify(
            entries, rows, materialize(table, "coefficients"), linear.intercept, penalty=penalty, **how
        )

    found, moved = certify(0.0), certify(MOVED)
    reached = summary.objectiveHistory[-1]
    agrees = abs(found.objective - reached) <= 1e-5 * (1 + abs(reached))
    moved_agrees = abs(moved.objective - reached) <= 1e-5 * (1 + abs(reached))
    allowed = ALLOWED.get(name)
    line = (
        name, rows.count(), agrees, allowed is None or found.gap <= allowed * summary.objectiveHistory[0],
        not moved_agrees,
    )
    schema = "solver string, n bigint, objective_agrees boolean, within_gap boolean, moved_fails boolean"
    return spark.createDataFrame([line], schema)


def _sql(name: str, rows: str) -> str:
    return (
        f"WITH {S.LABELLED} SELECT '{name}' AS solver, count(*) AS n, true AS objective_agrees, true AS within_gap, "
        f"true AS moved_fails FROM labelled {rows}"
    )


def _of_pipeline(spark, sf_dir, name: str, penalty: float, **how) -> DataFrame:
    train, _ = _split(spark, sf_dir)
    model = _model(spark, sf_dir, name, train)
    linear = model.stages[-1]
    summary = linear.summary() if name == "linear_svc" else linear.summary
    return _certified(spark, name, model.transform(train), linear, summary, penalty, **how)


TRAINED = f"WHERE {S.in_fraction('doc_id', 0.8)}"


@query("linear_svc_certificate", _sql("linear_svc", TRAINED))
def linear_svc_certificate(spark, sf_dir):
    return _of_pipeline(spark, sf_dir, "linear_svc", 0.1, loss="hinge")


@query("logistic_regression_certificate", _sql("logistic_regression", TRAINED))
def logistic_regression_certificate(spark, sf_dir):
    """Without a penalty no lower bound but zero is known: the objective is what is checked."""
    return _of_pipeline(spark, sf_dir, "logistic_regression", 0.0, loss="logistic")


@query("logistic_elasticnet_certificate", _sql("logistic_elasticnet", TRAINED))
def logistic_elasticnet_certificate(spark, sf_dir):
    return _of_pipeline(spark, sf_dir, "logistic_elasticnet", 0.3, loss="logistic", l1_share=0.8)


@query("svc_bigram_certificate", _sql("svc_bigram", ""))
def svc_bigram_certificate(spark, sf_dir):
    """The support vector machine on 1- and 2-gram weights, fitted on all labelled documents."""
    vectors = training.bigram_vectors(labelled(spark, sf_dir), F.col("text"), "doc_id", "label")
    vectors = materialize(vectors, "bigram-vectors")
    linear = training.classifier("linear_svc").fit(vectors)
    return _certified(spark, "svc_bigram", vectors, linear, linear.summary(), 0.1, loss="hinge")
