"""Trees as tables against MLlib; certificates of solvers that fail for other coefficients."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sentilode.operators import certificate, forest


@pytest.fixture(scope="module")
def points(spark):
    """Sparse rows: two features with few values, three with many, one that is always zero."""
    draw = np.random.default_rng(5)
    x = np.where(draw.random((240, 6)) < 0.4, 0.0, draw.normal(size=(240, 6)))
    x[:, :2] = draw.integers(0, 4, (240, 2))
    x[:, 5] = 0
    y = (x @ [1.0, -1.0, 2.0, -0.5, 0.0, 0.0] + draw.normal(size=240) > 0).astype(int)
    sparse = [Vectors.sparse(6, [(i, c) for i, c in enumerate(v) if c]) for v in x.tolist()]
    rows = [(k, int(label), v) for k, (v, label) in enumerate(zip(sparse, y))]
    return spark.createDataFrame(rows, ["doc_id", "label", "features"]).cache()


def entries(points, column="features"):
    flat = points.select("doc_id", F.posexplode(vector_to_array(column)).alias("index", "value"))
    return flat.filter("value <> 0")


@pytest.mark.parametrize("depth", [0, 3, 6])
def test_votes_are_those_of_the_trees(spark, points, depth):
    indexed = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=5).fit(points).transform(points)
    model = RandomForestClassifier(featuresCol="indexed", numTrees=7, maxDepth=depth, seed=3).fit(indexed)
    want = {r["doc_id"]: r["raw"] for r in model.transform(indexed).select("doc_id", vector_to_array("rawPrediction").alias("raw")).collect()}
    found = forest.votes(entries(indexed, "indexed"), indexed, model).collect()
    assert len(found) == 240
    for r in found:
        assert r["votes"] == pytest.approx(want[r["doc_id"]])


def test_every_tree_has_one_leaf_of_zeros(spark, points):
    model = RandomForestClassifier(numTrees=9, maxDepth=5, seed=1).fit(points)
    _, leaves = forest.leaf_paths(forest.tree_nodes(model))
    zero = leaves.filter("conditions = zeros").groupBy("tree").count().collect()
    assert len(zero) == 9 and {r["count"] for r in zero} == {1}


def coefficients(spark, values):
    return spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "index int, coefficient double")


SOLVERS = {
    "hinge": (lambda: LinearSVC(maxIter=200, regParam=0.1, tol=1e-9), dict(loss="hinge", penalty=0.1)),
    "ridge": (lambda: LogisticRegression(maxIter=200, regParam=0.2), dict(loss="logistic", penalty=0.2)),
    "net": (lambda: LogisticRegression(maxIter=200, regParam=0.1, elasticNetParam=0.8), dict(loss="logistic", penalty=0.1, l1_share=0.8)),
    "lasso": (lambda: LogisticRegression(maxIter=300, regParam=0.05, elasticNetParam=1.0), dict(loss="logistic", penalty=0.05, l1_share=1.0)),
    "zero": (lambda: LogisticRegression(maxIter=50, regParam=5.0, elasticNetParam=1.0), dict(loss="logistic", penalty=5.0, l1_share=1.0)),
}


@pytest.mark.parametrize("name", sorted(SOLVERS))
def test_certificates(spark, points, name):
    make, how = SOLVERS[name]
    model = make().fit(points)
    own = entries(points)
    found = certificate.certify(own, points, coefficients(spark, model.coefficients), model.intercept, **how)
    summary = model.summary() if name == "hinge" else model.summary
    assert found.objective == pytest.approx(summary.objectiveHistory[-1], rel=1e-5)
    assert -1e-9 <= found.gap <= (0.02 if name == "hinge" else 1e-3)
    moved = [c + 0.4 for c in model.coefficients]
    other = certificate.certify(own, points, coefficients(spark, moved), model.intercept, **how)
    assert other.gap > found.gap + 0.01 and other.objective > found.objective
    assert other.lower_bound <= found.objective + 1e-9


def test_without_penalty_only_the_objective(spark, points):
    model = LogisticRegression(maxIter=10).fit(points)
    found = certificate.certify(entries(points), points, coefficients(spark, model.coefficients), model.intercept, "logistic", 0.0)
    assert found.objective == pytest.approx(model.summary.objectiveHistory[-1], rel=1e-6) and found.lower_bound == 0.0
