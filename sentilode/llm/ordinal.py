"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sentilode.llm.common import slices, spread_texts, texts
from sentilode.llm.ngrams import hashed, sigmoid

LENGTHS = (1, 2, 3)
BITS = 18
# The model is fitted on at most so many graded rows, and so many characters of their texts.
FIT_ROWS = 8_000
FIT_CHARS = 32 << 20
PENALTY = 1e-5
STEPS = 300
# A text is kept if its grade is 1 or more with at least this probability.
KEEP_GRADE, KEEP_PROBABILITY = 1, 0.5


def features(text: str, lengths: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, value): log counts of hashed n-grams, scaled to length 1."""
    found, counts = np.unique(hashed(text, lengths, bits), return_counts=True)
    value = np.log1p(counts.astype(np.float64))
    return found, value / max(np.sqrt((value * value).sum()), 1e-12)


def thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free numbers: the first as it is, then positive steps."""
    return np.concatenate([free[:1], free[:1] + np.cumsum(np.exp(free[1:]))])


def tail(margin: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k from 1, one column per threshold."""
    return sigmoid(margin[:, None] - cuts[None, :])


def fit_ordinal(
    found: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, size: int, penalty: float, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by the likelihood of grades 0 to n_grades - 1, accelerated gradient descent.

    The weights are shared by all thresholds. The thresholds start at the smoothed shares of the grades.
    """
    n = len(grades)
    counts = np.bincount(grades, minlength=n_grades) + 1.0
    above = 1 - np.cumsum(counts)[:-1] / counts.sum()
    start = -np.log(above / (1 - above))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    w = np.zeros(size)
    if n == 0 or grades.min() == grades.max():
        return w, start
    columns = np.concatenate([f for f, _ in found])
    value = np.concatenate([v for _, v in found])
    owner = np.repeat(np.arange(n), [len(f) for f, _ in found])
    # A step of 1 over the largest curvature: rows have length 1 or less.
    vw, vf, t, rate = w.copy(), free.copy(), 1.0, 4.0
    rows = np.arange(n)
    for _ in range(steps):
        cuts = thresholds(vf)
        over = np.hstack([np.ones((n, 1)), tail(np.bincount(owner, value * vw[columns], n), cuts), np.zeros((n, 1))])
        slope = over * (1 - over)
        p = np.maximum(over[rows, grades] - over[rows, grades + 1], 1e-12)
        # Derivatives of -log p by the margin and by each threshold.
        by_margin = -(slope[rows, grades] - slope[rows, grades + 1]) / p / n
        by_cut = np.zeros(len(cuts))
        np.add.at(by_cut, np.maximum(grades - 1, 0), np.where(grades > 0, slope[rows, grades] / p / n, 0.0))
        last = len(cuts) - 1
        np.add.at(by_cut, np.minimum(grades, last), np.where(grades <= last, -slope[rows, grades + 1] / p / n, 0.0))
        gw = np.bincount(columns, value * by_margin[owner], size) + penalty * vw
        gf = np.concatenate([[by_cut.sum()], [by_cut[k:].sum() * np.exp(vf[k]) for k in range(1, len(cuts))]])
        w2, f2 = vw - rate * gw, vf - 0.5 * gf
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vf = w2 + (t - 1) / t2 * (w2 - w), f2 + (t - 1) / t2 * (f2 - free)
        w, free, t = w2, f2, t2
    return w, thresholds(free)


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 for poor texts, 1 for good but toxic ones, 2 for good ones; null labels teach nothing."""
    quality, toxic = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(quality == 0, F.lit(0)).when((quality == 1) & (toxic == 1), F.lit(1)).when((quality == 1) & (toxic == 0), F.lit(2)).alias("grade"),
    ).filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())


def in_training(doc_id: Column) -> Column:
    """Two thirds of the ids, by a hash; the rest measures the model."""
    return F.pmod(F.xxhash64(doc_id, F.lit("ordinal")), F.lit(3)) != 1


def _fit(n_grades: int, most_rows: int, most_chars: int, lengths, bits: int, penalty: float, steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, grades, size = [], [], 0
        for batch in slices(batches):
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
                if len(found) < most_rows and size < most_chars:
                    size += len(text)
                    found.append(features(text, lengths, bits))
                    grades.append(grade)
        w, cuts = fit_ordinal(found, np.array(grades, np.int64), n_grades, 1 << bits, penalty, steps)
        model = {"weights": w.astype(np.float32), "cuts": cuts, "lengths": lengths, "bits": bits}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def train(
    docs: DataFrame,
    graded: DataFrame,
    n_grades: int = 3,
    lengths: tuple[int, ...] = LENGTHS,
    bits: int = BITS,
    fit_rows: int = FIT_ROWS,
    fit_chars: int = FIT_CHARS,
    penalty: float = PENALTY,
    steps: int = STEPS,
) -> dict:
    """The model from (doc_id, grade) with grades 0 to n_grades - 1.

    It is fitted in one task on at most `fit_rows` training rows and `fit_chars` characters, drawn by a hash of the
    id. Null texts, ids and grades teach nothing. Without rows, or with one grade alone, weights are 0.
    """
    known = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    usable = graded.filter(F.col("grade").between(0, n_grades - 1) & in_training(F.col("doc_id")))
    total = usable.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("grades")), F.lit(1_000_000))
    drawn = usable.filter(draw < int(min(1.0, 1.1 * fit_rows / max(total, 1)) * 1_000_000))
    rows = texts(known).join(drawn.select("doc_id", "grade"), "doc_id").select("doc_id", "text", "grade")
    fit = _fit(n_grades, fit_rows, fit_chars, lengths, bits, penalty, steps)
    found = rows.repartition(1).sortWithinPartitions("doc_id", "grade", "text").mapInArrow(fit, "model binary")
    row = found.first()
    # Without any rows Spark may run no task.
    return pickle.loads(row["model"] if row else next(fit(iter([]))).column("model")[0].as_py())


def _score(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = model["weights"].astype(np.float64)
        norms = np.zeros(1 << model["bits"], np.int32)
        for batch in slices(batches):
            margins = []
            for text in batch.column("text").to_pylist():
                places = hashed(text, model["lengths"], model["bits"])
                # Counts through one reused table: each feature is read at its last place only.
                at = np.arange(len(places), dtype=np.int32)
                norms[places] = at
                last = norms[places] == at
                found = places[last]
                slot = np.empty(len(places), np.int32)
                slot[last] = np.arange(len(found), dtype=np.int32)
                value = np.log1p(np.bincount(slot[norms[places]], minlength=len(found)))
                margins.append((value * weights[found]).sum() / max(np.sqrt((value * value).sum()), 1e-12))
            over = tail(np.array(margins, np.float64), model["cuts"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(over.sum(axis=1)), pa.array(list(over), pa.list_(pa.float64()))],
                ["doc_id", "expected_grade", "tails"],
            )

    return run


def grade(
    docs: DataFrame, model: dict, keep_grade: int = KEEP_GRADE, keep_probability: float = KEEP_PROBABILITY
) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) per input row, from the whole text.

    `tail_probability` is that of grade `keep_grade` or more, and decides on `kept`. A null text is graded
    as an empty one; a null id is kept; repeated rows are graded alike; an empty table gives an empty one;
    other columns are ignored. The model has a fixed size and is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = spread_texts(docs).mapInArrow(_score(shared), "doc_id bigint, expected_grade double, tails array<double>")
    probability = F.element_at("tails", keep_grade)
    return scored.select(
        "doc_id", "expected_grade", probability.alias("tail_probability"), (probability >= keep_probability).alias("kept")
    )
