"""The indexer of values beside Spark's own fit, and the work that it leaves to that."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from sentilode.operators.stages import ValueIndexer

COLUMNS = dict(inputCol="features", outputCol="indexed", handleInvalid="keep")


@pytest.fixture(scope="module")
def vectors(spark):
    """Features: few values; few, never 0; many; stored zeros; negative ones; at the bounds with and without 0; always 0."""
    draw = np.random.default_rng(11)
    rows = []
    for k in range(300):
        full = [
            float(draw.integers(0, 3)), 1.0 + draw.integers(0, 2), draw.normal(), 0.0, -1.5 if k % 2 else 0.0,
            float(k % 5), 1.0 + k % 5, 1.0 + k % 6, 0.0,
        ]
        stored = [i for i, c in enumerate(full) if c or (i == 3 and k % 2)]
        rows.append((k, Vectors.dense(full) if k % 7 == 0 else Vectors.sparse(9, stored, [full[i] for i in stored])))
    return spark.createDataFrame(rows, ["doc_id", "features"]).repartition(5)


@pytest.mark.parametrize("most", [2, 5, 6, 20])
def test_model_is_that_of_the_vector_indexer(vectors, most):
    ours = ValueIndexer(maxCategories=most, **COLUMNS).fit(vectors)
    theirs = VectorIndexer(maxCategories=most, **COLUMNS).fit(vectors)
    assert ours.numFeatures == theirs.numFeatures == 9
    maps = [{f: dict(m) for f, m in dict(model.categoryMaps).items()} for model in (ours, theirs)]
    assert maps[0] == maps[1] and 8 in maps[0] and 2 not in maps[0]
    told = [model.transform(vectors) for model in (ours, theirs)]
    assert told[0].schema["indexed"].metadata == told[1].schema["indexed"].metadata
    assert sorted(told[0].select("doc_id", "indexed").collect()) == sorted(told[1].select("doc_id", "indexed").collect())


def test_spark_sees_as_many_vectors_as_a_feature_has_values(vectors, monkeypatch):
    """The work of Spark's own fit, all features of a vector, does not grow with the rows."""
    seen = []
    fit = VectorIndexer._fit

    def counted(self, dataset: DataFrame):
        seen.append(dataset.count())
        return fit(self, dataset)

    monkeypatch.setattr(VectorIndexer, "_fit", counted)
    ValueIndexer(maxCategories=5, **COLUMNS).fit(vectors)
    ValueIndexer(maxCategories=5, **COLUMNS).fit(vectors.union(vectors))
    assert seen == [6, 6]


def test_the_pipeline_of_the_forest_learns_by_it():
    from sentilode.plans import training

    (indexer,) = [s for s in training.pipeline("random_forest", ["day"]).getStages() if isinstance(s, VectorIndexer)]
    assert isinstance(indexer, ValueIndexer)


def test_no_rows_and_unequal_sizes_fail_as_before(spark, vectors):
    other = spark.createDataFrame([(1, Vectors.sparse(4, [1], [2.0]))], ["doc_id", "features"])
    for rows in (vectors.limit(0), vectors.union(other)):
        with pytest.raises(Exception):
            VectorIndexer(**COLUMNS).fit(rows)
        with pytest.raises(Exception):
            ValueIndexer(**COLUMNS).fit(rows)


@pytest.mark.parametrize("odd", [-0.0, float("nan")])
def test_values_that_sets_count_otherwise(spark, vectors, odd):
    more = spark.createDataFrame([(k, Vectors.sparse(9, [5, 8], [odd, odd])) for k in range(2)], ["doc_id", "features"])
    rows = vectors.union(more)
    ours, theirs = (kind(maxCategories=6, **COLUMNS).fit(rows) for kind in (ValueIndexer, VectorIndexer))
    maps = [{f: dict(m) for f, m in dict(model.categoryMaps).items()} for model in (ours, theirs)]
    assert maps[0].keys() == maps[1].keys() and all(maps[0][f] == maps[1][f] for f in maps[0] if f not in (5, 8))


def test_parameters_of_the_fit_and_copies(vectors):
    indexer = ValueIndexer(**COLUMNS)
    model = indexer.fit(vectors, {indexer.maxCategories: 2})
    assert model.getMaxCategories() == 2 and model.uid == indexer.uid and model.getOutputCol() == "indexed"
    again = Pipeline(stages=[indexer]).fit(vectors.filter(F.col("doc_id") < 50)).stages[0]
    assert again.numFeatures == 9
