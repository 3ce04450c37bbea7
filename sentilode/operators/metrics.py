"""Classification metrics from the counts per (label, prediction)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

CLASS_NAMES = ("Negative", "Positive")


def outcome_counts(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n): the only pass over the predictions."""
    return predictions.groupBy(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def _n(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def accuracy(counts: DataFrame) -> DataFrame:
    """(accuracy, accuracy_percent, n)"""
    right = _n(F.col("label") == F.col("prediction"))
    total = F.sum("n")
    return counts.agg(
        (right / total).alias("accuracy"),
        (right * 100 / total).alias("accuracy_percent"),
        total.alias("n"),
    )


def balanced_accuracy(counts: DataFrame) -> DataFrame:
    """The area under ROC of hard predictions: the mean of both classes' recall."""
    label, pred = F.col("label"), F.col("prediction")
    tpr = _ratio(_n((label == 1) & (pred == 1)), _n(label == 1))
    tnr = _ratio(_n((label == 0) & (pred == 0)), _n(label == 0))
    return counts.agg(((tpr + tnr) / 2).alias("balanced_accuracy"))


def classes_of(counts: DataFrame) -> list[int]:
    """The labels that occur as truth or prediction, in order; 0 and 1 if there are none."""
    both = counts.select(F.col("label").alias("c")).union(counts.select(F.col("prediction").alias("c")))
    return sorted(r["c"] for r in both.filter(F.col("c").isNotNull()).distinct().collect()) or [0, 1]


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """(label, predicted_<class>...): a row and a column for every label that occurs; rows are the truth."""
    classes = classes_of(counts)
    label, pred = F.col("label"), F.col("prediction")
    cells = counts.agg(*[_n((label == a) & (pred == b)).alias(f"n{i}_{j}") for i, a in enumerate(classes) for j, b in enumerate(classes)])
    rows = [
        F.struct(F.lit(a).cast("int").alias("label"), *[F.col(f"n{i}_{j}").alias(f"predicted_{b}") for j, b in enumerate(classes)])
        for i, a in enumerate(classes)
    ]
    return cells.select(F.inline(F.array(*rows)))


def classification_report(counts: DataFrame, digits: int = 4) -> DataFrame:
    """(row, precision, recall, f1, support): every label that occurs, accuracy, macro and weighted means."""
    classes = classes_of(counts)
    names = [CLASS_NAMES[c] if c in (0, 1) else str(c) for c in classes]
    label, pred = F.col("label"), F.col("prediction")
    each = range(len(classes))
    sums = counts.agg(
        *[_n((label == c) & (pred == c)).alias(f"hit{i}") for i, c in enumerate(classes)],
        *[_n(label == c).alias(f"truth{i}") for i, c in enumerate(classes)],
        *[_n(pred == c).alias(f"said{i}") for i, c in enumerate(classes)],
        F.sum("n").alias("total"),
    )
    scored = sums.select(
        "*",
        *[_ratio(F.col(f"hit{i}"), F.col(f"said{i}")).alias(f"p{i}") for i in each],
        *[_ratio(F.col(f"hit{i}"), F.col(f"truth{i}")).alias(f"r{i}") for i in each],
    )
    scored = scored.select(
        "*", *[_ratio(2 * F.col(f"p{i}") * F.col(f"r{i}"), F.col(f"p{i}") + F.col(f"r{i}")).alias(f"f{i}") for i in each]
    )

    def line(name, precision, recall, score, support) -> Column:
        cells = {"precision": precision, "recall": recall, "f1": score}
        return F.struct(
            F.lit(name).alias("row"),
            *[F.round(v.cast("double"), digits).alias(k) for k, v in cells.items()],
            support.cast("bigint").alias("support"),
        )

    def mean(kind: str, weights: list[Column]) -> Column:
        return _ratio(_add([F.col(f"{kind}{i}") * w for i, w in enumerate(weights)]), _add(weights))

    total = F.col("total")
    one, support = [F.lit(1) for _ in each], [F.col(f"truth{i}") for i in each]
    lines = [line(names[i], F.col(f"p{i}"), F.col(f"r{i}"), F.col(f"f{i}"), support[i]) for i in each]
    lines.append(line("accuracy", F.lit(None), F.lit(None), _ratio(_add([F.col(f"hit{i}") for i in each]), total), total))
    for name, weights in (("macro avg", one), ("weighted avg", support)):
        lines.append(line(name, *[mean(kind, weights) for kind in "prf"], total))
    return scored.select(F.inline(F.array(*lines)))


def _add(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
