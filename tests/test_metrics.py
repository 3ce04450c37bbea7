"""The published reports follow from the published confusion matrices."""

from __future__ import annotations

import pytest

from sentilode.operators import metrics
from sentilode.sources.results import write_report

# Matrix, "accuracy" (balanced), true accuracy, and the rows of each report.
PUBLISHED = {
    "logistic regression": (
        [[119614, 40101], [35383, 123953]], 0.7634280976843432, 0.7634108653,
        [(0.7717, 0.7489, 0.7601, 159715), (0.7556, 0.7779, 0.7666, 159336),
         (None, None, 0.7634, 319051), (0.7636, 0.7634, 0.7634, 319051), (0.7636, 0.7634, 0.7634, 319051)],
    ),
    "naive Bayes": (
        [[122937, 37680], [41984, 118104]], 0.7515744494770578, 0.7515972623,
        [(0.7454, 0.7654, 0.7553, 160617), (0.7581, 0.7377, 0.7478, 160088),
         (None, None, 0.7516, 320705), (0.7518, 0.7516, 0.7515, 320705), (0.7518, 0.7516, 0.7515, 320705)],
    ),
    "linear SVM": (
        [[120513, 39593], [33017, 127123]], 0.7732658675464024, 0.7732680502,
        [(0.7849, 0.7527, 0.7685, 160106), (0.7625, 0.7938, 0.7779, 160140),
         (None, None, 0.7733, 320246), (0.7737, 0.7733, 0.7732, 320246), (0.7737, 0.7733, 0.7732, 320246)],
    ),
}


def counts(spark, matrix):
    cells = [(t, p, matrix[t][p]) for t in (0, 1) for p in (0, 1)]
    return spark.createDataFrame(cells, "label int, prediction int, n bigint")


@pytest.mark.parametrize("model", list(PUBLISHED))
def test_published(spark, model):
    matrix, balanced, true, report = PUBLISHED[model]
    table = counts(spark, matrix)
    assert metrics.balanced_accuracy(table).first()[0] == pytest.approx(balanced, abs=1e-15)
    row = metrics.accuracy(table).first()
    assert row["accuracy"] == pytest.approx(true, abs=1e-10)
    assert row["accuracy_percent"] == pytest.approx(100 * true, abs=1e-8)
    lines = metrics.classification_report(table).collect()
    assert [tuple(r)[1:] for r in lines] == report
    assert [r["row"] for r in lines] == ["Negative", "Positive", "accuracy", "macro avg", "weighted avg"]
    got = {r["label"]: [r["predicted_0"], r["predicted_1"]] for r in metrics.confusion_matrix(table).collect()}
    assert got == {0: matrix[0], 1: matrix[1]}


def test_a_class_that_is_never_predicted(spark):
    predictions = spark.createDataFrame([(0, 0.0), (1, 0.0), (0, 0.0)], "label int, prediction double")
    table = metrics.outcome_counts(predictions)
    lines = {r["row"]: r for r in metrics.classification_report(table).collect()}
    assert lines["Positive"]["precision"] == lines["Positive"]["f1"] == 0.0
    assert metrics.balanced_accuracy(table).first()[0] == 0.5


def test_reports_are_written(spark, tmp_path):
    table = counts(spark, PUBLISHED["naive Bayes"][0])
    write_report(
        str(tmp_path), accuracy=metrics.accuracy(table), report=metrics.classification_report(table)
    )
    assert spark.read.json(str(tmp_path / "report")).count() == 5
    assert spark.read.json(str(tmp_path / "accuracy")).first()["n"] == 320705


def test_labels_that_occur(spark):
    """A label that only one of truth and prediction has gets its row and column."""
    rows = [(1, 1), (1, 0), (1, 2), (3, 1)]
    counts = metrics.outcome_counts(spark.createDataFrame(rows, "label int, prediction int"))
    matrix = {r["label"]: tuple(r)[1:] for r in metrics.confusion_matrix(counts).collect()}
    assert matrix == {0: (0, 0, 0, 0), 1: (1, 1, 1, 0), 2: (0, 0, 0, 0), 3: (0, 1, 0, 0)}
    report = {r["row"]: tuple(r)[1:] for r in metrics.classification_report(counts).collect()}
    assert report["Positive"] == (0.5, 0.3333, 0.4, 3) and report["3"] == (0.0, 0.0, 0.0, 1)
    assert report["2"] == (0.0, 0.0, 0.0, 0) and report["accuracy"][2:] == (0.25, 4)
