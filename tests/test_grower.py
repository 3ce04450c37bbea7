"""The forest grown from entries against Spark's own: the same trees, counts and predictions, and no dense row kept."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sentilode.operators import grower
from sentilode.plans import training


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """A function of (rows, features): sparse ones, half of the features with few values, in several parts of a written table."""

    def make(n, width):
        draw = np.random.default_rng(n)
        x = np.where(draw.random((n, width)) < 0.7, 0.0, draw.normal(size=(n, width)).round(2))
        x[:, : width // 2] = np.where(x[:, : width // 2] != 0, draw.integers(0, 6, (n, width // 2)), 0)
        y = (x[:, 0] - x[:, 1] + 2 * x[:, -1] - x[:, -2] + draw.normal(size=n) > 0).astype(int)
        sparse = [Vectors.sparse(width, [(i, c) for i, c in enumerate(v) if c]) for v in x.tolist()]
        path = str(tmp_path_factory.mktemp("points") / "table")
        spark.createDataFrame(list(zip(y.tolist(), sparse)), ["label", "features"]).repartition(3).write.parquet(path)
        points = spark.read.parquet(path)
        return VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=20, handleInvalid="keep").fit(points).transform(points)

    return make


def shape(model):
    """All that a model tells of its trees."""

    def of(node):
        own = [node.prediction(), node.impurity(), node.impurityStats().toString(), node.impurityStats().rawCount()]
        return own if node.subtreeDepth() == 0 else [*own, node.gain(), of(node.leftChild()), of(node.rightChild())]

    return model.toDebugString.split("\n", 1)[1], [of(tree.rootNode()) for tree in model._java_obj.trees()]


@pytest.mark.parametrize(
    "n, width, settings",
    [
        (400, 300, dict(numTrees=10, maxDepth=3, seed=42)),
        (300, 8, dict(numTrees=7, maxDepth=6, seed=3, minInstancesPerNode=3, minInfoGain=0.01)),
        (10_500, 30, dict(numTrees=3, maxDepth=3, seed=-5)),  # more rows than the sample for the splits
        (400, 40, dict(numTrees=2, maxDepth=2, maxMemoryInMB=0, seed=1)),  # a node at a time
    ],
)
def test_the_trees_are_those_of_sparks_fit(spark, rows, n, width, settings, monkeypatch):
    points = rows(n, width)
    want = RandomForestClassifier(featuresCol="indexed", **settings).fit(points)
    with monkeypatch.context() as patch:
        patch.setattr(RandomForestClassifier, "_fit", None)
        found = grower.EntryForest(featuresCol="indexed", **settings).fit(points)
    assert type(found) is RandomForestClassificationModel
    assert shape(found) == shape(want)
    scores = [[tuple(r) for r in m.transform(points).select("rawPrediction", "prediction").collect()] for m in (found, want)]
    assert scores[0] == scores[1]


def test_a_saved_model_and_its_settings(spark, rows, tmp_path):
    found = grower.EntryForest(featuresCol="indexed", numTrees=2, maxDepth=2, seed=4).fit(rows(100, 6))
    found.write().save(str(tmp_path / "model"))
    again = RandomForestClassificationModel.load(str(tmp_path / "model"))
    assert shape(again) == shape(found) and (again.getFeaturesCol(), again.getMaxDepth()) == ("indexed", 2)


def test_other_settings_and_inputs_are_sparks(spark, rows):
    points = rows(100, 6)
    for settings in (dict(impurity="entropy"), dict(subsamplingRate=0.5)):
        own, want = (kind(featuresCol="indexed", **(dict(numTrees=2, seed=4) | settings)).fit(points) for kind in (grower.EntryForest, RandomForestClassifier))
        assert shape(own) == shape(want)
    three = points.withColumn("label", F.col("label") + (F.rand(1) < 0.3).cast("int"))
    own, want = (kind(featuresCol="features", numTrees=2, seed=4).fit(three) for kind in (grower.EntryForest, RandomForestClassifier))
    assert own.numClasses == 3 and shape(own) == shape(want)
    nan = points.select("label", F.col("features").alias("indexed")).limit(20).union(spark.createDataFrame([(1, Vectors.dense([float("nan")] * 6))]))
    with pytest.raises(Exception, match="(?i)nan"):
        grower.EntryForest(featuresCol="indexed").fit(nan)
    with pytest.raises(Exception):
        grower.EntryForest(featuresCol="indexed").fit(points.withColumn("label", F.lit(None).cast("int")))


def test_a_row_keeps_its_entries_alone(spark, monkeypatch):
    """262,144 features: what is written of a row is its weights and the bins of its entries."""
    assert isinstance(training.classifier("random_forest"), grower.EntryForest)
    wide = [(k % 2, Vectors.sparse(1 << 18, [k % 3, 7, 200_000 + k], [1.0, float(k + 1), 2.0])) for k in range(40)]
    points = spark.createDataFrame(wide, ["label", "features"])
    kept = []
    keep = grower.materialize
    monkeypatch.setattr(grower, "materialize", lambda df, name: kept.append(keep(df, name)) or kept[-1])
    monkeypatch.setattr(RandomForestClassifier, "_fit", None)
    model = grower.EntryForest(numTrees=2, maxDepth=2, seed=1).fit(points)
    assert model.numFeatures == 1 << 18
    (table,) = kept
    assert table.count() == 40 and table.agg(F.max(F.size("index"))).first()[0] <= 3 and table.agg(F.min(F.size("weights"))).first()[0] == 2


def test_thresholds():
    cut = lambda values, counts, rows, most: grower.thresholds(np.array(values), np.array(counts), rows, most)
    assert cut([-1.0, 2.0], [1, 1], 4.0, 31) == [-0.5, 1.0]
    assert cut([1.0, 2.0], [2, 2], 4.0, 31) == [1.5]
    assert cut([1.0], [4], 4.0, 31) == []
    assert cut([1.0, 2.0, 3.0, 4.0], [1, 1, 1, 1], 4.0, 1) == [2.5]
