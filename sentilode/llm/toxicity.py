"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sentilode.llm.common import let_go, slices, spread_texts, texts
from sentilode.llm.ngrams import Presence, hashed, sigmoid
from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

LENGTHS = (4, 5, 6, 7)
BITS = 20
# Pseudo-texts of each label, in equal shares, that a feature starts with.
SMOOTHING = 2.0
# Features in fewer texts, or that tell the labels apart by less, are left out.
MIN_TEXTS, MIN_RATIO = 2, 2.0
# The linear model is fitted on at most so many labelled rows and characters of texts; the ratios use all rows.
FIT_ROWS = 8_000
FIT_CHARS = 32 << 20
PENALTY = 1e-3
# Bytes of labelled texts that a task counts the features of.
COUNT_BYTES = 128 << 20
STEPS = 150
# Each of so many parts of the labelled rows is scored by a model of the others, to turn margins into probabilities.
FOLDS = 3
THRESHOLD = 0.7
MODEL_SCHEMA = "model binary"


def held_out(doc_id: Column) -> Column:
    """Rows that the model must not learn from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _count(lengths: tuple[int, ...], bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(lengths, bits)
        counts = np.zeros((2 * FOLDS, (1 << bits) + 1), np.int32)
        for batch in slices(batches):
            for text, label, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "fold"))):
                own = counts[label * FOLDS + fold]
                own[presence(text)] += 1
                own[-1] += 1
        used = np.flatnonzero(counts.any(axis=0))
        for k in range(0, len(used), 100_000):
            block = used[k:k + 100_000]
            feature = np.where(block == 1 << bits, -1, block).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature), *[pa.array(row[block].astype(np.int64)) for row in counts]], ["feature", *COUNTS]
            )

    return run


COUNTS = [f"n{label}_{fold}" for label in (0, 1) for fold in range(FOLDS)]


def feature_counts(
    labelled: DataFrame, lengths: tuple[int, ...] = LENGTHS, bits: int = BITS, smoothing: float = SMOOTHING,
    min_texts: int = MIN_TEXTS, min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """(feature, texts with it per label and fold) from all rows of (text, label, fold), for features that tell the labels apart.

    Counts are added up in each task first, so a task sends one row per feature at most; feature -1 counts the texts.
    """
    counted = labelled.mapInArrow(_count(lengths, bits), "feature int, " + ", ".join(f"{c} bigint" for c in COUNTS))
    counted = materialize(counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in COUNTS]), "toxicity-counts")
    n = [reduce(lambda a, b: a + b, [F.col(f"n{label}_{k}") for k in range(FOLDS)]) for label in (0, 1)]
    every = counted.filter(F.col("feature") == -1).select(n[0].alias("n0"), n[1].alias("n1")).first()
    if every is None or not every["n0"] or not every["n1"]:
        return counted.filter(F.col("feature") == -1)
    share = [(n[y] * (sum(every) / every[f"n{y}"]) + smoothing) for y in (1, 0)]
    telling = (n[0] + n[1] >= min_texts) & (F.abs(F.log(share[0] / share[1])) >= min_ratio)
    return counted.filter((F.col("feature") == -1) | telling)


def log_count_ratios(
    feature: np.ndarray, n1: np.ndarray, n0: np.ndarray, bits: int,
    smoothing: float = SMOOTHING, min_texts: int = MIN_TEXTS, min_ratio: float = MIN_RATIO,
) -> np.ndarray:
    """Per feature the log of its share of toxic texts over that of other texts, 0 if it tells nothing."""
    out = np.zeros(1 << bits)
    own = feature >= 0
    all1, all0 = max(1, n1[~own].sum()), max(1, n0[~own].sum())
    feature, n1, n0 = feature[own], n1[own], n0[own]
    ratio = np.log((n1 * ((all1 + all0) / all1) + smoothing) / (n0 * ((all1 + all0) / all0) + smoothing))
    ratio[(n1 + n0 < min_texts) | (np.abs(ratio) < min_ratio)] = 0.0
    out[feature] = ratio
    return out


def fit_linear(
    found: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, penalty: float, steps: int
) -> np.ndarray:
    """The weight per feature of a logistic model on features times ratio, by accelerated gradient descent.

    A text's features are scaled to length 1, so that long texts do not outweigh short ones, and either class has half of
    the weight. The result is the product of learned weight and ratio; one class alone gives weights of 0.
    """
    n = len(labels)
    out = np.zeros(len(ratio))
    if n == 0 or labels.min() == labels.max():
        return out
    columns, place = np.unique(np.concatenate(found), return_inverse=True)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in found])
    value = ratio[columns][place]
    norm = np.sqrt(np.bincount(owner, value * value, n))
    value /= np.maximum(norm, 1e-12)[owner]
    part = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))
    # A step of 1 over the largest curvature: rows have length 1 and a bias.
    rate = 2.0
    w, b = np.zeros(len(columns)), 0.0
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = (sigmoid(np.bincount(owner, value * vw[place], n) + vb) - labels) * part
        w2 = vw - rate * (np.bincount(place, value * error[owner], len(columns)) + penalty * vw)
        b2 = vb - rate * error.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    out[columns] = w * ratio[columns]
    return out


def calibrate(margins: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """(slope, shift) so that sigmoid(slope * margin + shift) is the probability of a label, after Platt.

    Newton steps on the likelihood of smoothed labels. With one label alone the shift gives the share of label 1.
    """
    ones, zeros = labels.sum(), (1 - labels).sum()
    if not ones or not zeros or margins.max() == margins.min():
        return 1.0, float(np.log(share / (1 - share)))
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = margins.std()
    x = np.stack([margins / scale, np.ones(len(margins))])
    theta = np.array([1.0, np.log((ones + 1) / (zeros + 1))])

    def loss(at: np.ndarray) -> float:
        z = at @ x
        return float((np.logaddexp(0, z) - goal * z).sum() + 1e-3 * at[0] ** 2)

    for _ in range(60):
        p = sigmoid(theta @ x)
        slope = x @ (p - goal) + np.array([2e-3 * theta[0], 0])
        curve = (x * (p * (1 - p))) @ x.T + np.diag([2e-3, 1e-9])
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
    return float(max(theta[0], 1e-3) / scale), float(theta[1])


def margins(found: list[np.ndarray], weights: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The margin of each text by its features."""
    return np.array([weights[f].sum() / max(np.sqrt((ratio[f] ** 2).sum()), 1e-12) for f in found])


def fit_model(
    rows: Iterator[tuple[str, int, int]], counts: dict[str, np.ndarray], lengths: tuple[int, ...], bits: int, penalty: float, steps: int
) -> dict:
    """The model from (text, label, fold) and the counts of every feature per label and fold.

    Ratios and weights of a fold's calibration come from the other folds alone; those of the model from all.
    """
    found, labels, folds = [], [], []
    telling = np.zeros(1 << bits, bool)
    telling[counts["feature"][counts["feature"] >= 0]] = True
    for text, label, fold in rows:
        own = hashed(text, lengths, bits)
        found.append(np.unique(own[telling[own]]))
        labels.append(label)
        folds.append(fold)
    y, fold = np.array(labels, np.float64), np.array(folds, np.int64)

    def fitted(which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        n1, n0 = (sum((counts[f"n{label}_{k}"] for k in which), np.zeros(len(counts["feature"]))) for label in (1, 0))
        ratio = log_count_ratios(counts["feature"], n1, n0, bits)
        use = np.flatnonzero(np.isin(fold, which))
        return fit_linear([found[k][ratio[found[k]] != 0] for k in use], y[use], ratio, penalty, steps), ratio

    left = np.zeros(len(y))
    for k in range(FOLDS):
        out = np.flatnonzero(fold == k)
        weights, ratio = fitted([j for j in range(FOLDS) if j != k])
        left[out] = margins([found[i] for i in out], weights, ratio)
    weights, ratio = fitted(list(range(FOLDS)))
    slope, shift = calibrate(left, y, (y.sum() + 1) / (len(y) + 2))
    used = np.flatnonzero(ratio)
    return {
        "used": used.astype(np.int32), "ratio": ratio[used].astype(np.float32), "weights": weights[used].astype(np.float32),
        "lengths": lengths, "bits": bits, "slope": slope, "shift": shift,
    }


def _fit(counts: dict, most_rows: int, most_chars: int, *how) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, int, int]]:
            n = size = 0
            for batch in slices(batches):
                for row in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "fold"))):
                    if n < most_rows and size < most_chars:
                        n, size = n + 1, size + len(row[0])
                        yield row

        model = fit_model(rows(), counts, *how)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    lengths: tuple[int, ...] = LENGTHS,
    bits: int = BITS,
    smoothing: float = SMOOTHING,
    penalty: float = PENALTY,
    steps: int = STEPS,
    fit_rows: int = FIT_ROWS,
    fit_chars: int = FIT_CHARS,
) -> dict:
    """The model learned from labelled rows that are not held out.

    Log-count ratios come from all of them. The linear model is fitted, and calibrated by folds, in one task on at most
    `fit_rows` rows and `fit_chars` characters, drawn by a hash of the id. Rows with a null text, id or label, or with a
    label other than 0 and 1, teach nothing. An id labelled more than once teaches each of its labels. The model has 2**bits
    features at most, so what the driver gets does not grow with the data.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    # Ids and bits of labels are small beside texts: while they are, no text is shuffled to meet its label, and none is written again.
    usable = materialize(usable, "toxicity-labels")
    small = measured_bytes(usable) <= BROADCAST_BYTES
    labelled = texts(known).join(F.broadcast(usable) if small else usable, "doc_id")
    labelled = labelled.select("doc_id", "text", "label", fold.alias("fold"))
    if not small:
        labelled = materialize(labelled, "toxicity-labelled")
    size = labelled.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes")).first()
    total = size["n"]
    # A task sends up to all features, whatever it reads: so few tasks count, without a shuffle of texts.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-(size["bytes"] or 0) // COUNT_BYTES))
    table = feature_counts(labelled.select("text", "label", "fold").coalesce(int(tasks)), lengths, bits, smoothing).toArrow()
    counts = {c: table.column(c).to_numpy() for c in ("feature", *COUNTS)}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000))
    drawn = labelled.filter(draw < int(min(1.0, 1.1 * fit_rows / max(total, 1)) * 1_000_000))
    fit = _fit(counts, fit_rows, fit_chars, lengths, bits, penalty, steps)
    # One task: the rows are few by the parameter, and in a fixed order.
    drawn = drawn.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label", "text")
    row = drawn.mapInArrow(fit, MODEL_SCHEMA).first()
    # Without any rows Spark may run no task.
    return pickle.loads(row["model"] if row else next(fit(iter([]))).column("model")[0].as_py())


class Scorer:
    """Scores of texts by a model, in one task."""

    def __init__(self, model: dict) -> None:
        self.how = model["lengths"], model["bits"]
        self.telling = np.zeros(1 << model["bits"], bool)
        self.telling[model["used"]] = True
        self.weights = np.zeros(1 << model["bits"], np.float64)
        self.square = np.zeros(1 << model["bits"], np.float64)
        self.weights[model["used"]] = model["weights"]
        self.square[model["used"]] = model["ratio"].astype(np.float64) ** 2
        self.slope, self.shift = model["slope"], model["shift"]

    def margin(self, text: str) -> float:
        found = hashed(text, *self.how)
        found = np.unique(found[self.telling[found]])
        return self.weights[found].sum() / max(np.sqrt(self.square[found].sum()), 1e-12)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return sigmoid(self.slope * np.array([self.margin(text or "") for text in texts], np.float64) + self.shift)


def _score(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            scores = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def drop_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that score below `threshold`; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            yield batch.filter(pa.array(scorer(batch.column(text_col).to_pylist()) < threshold))
        del scorer
        let_go()

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) per input row, from the whole text alone.

    A null text scores as an empty one, which gets the score of a text without known features; a null id is kept
    and not held out; repeated rows get the same score; other columns are ignored; an empty table gives an
    empty one. The model, bounded by its number of features, is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = spread_texts(docs).mapInArrow(_score(shared), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
