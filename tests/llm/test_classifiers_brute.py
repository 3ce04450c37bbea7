"""Toxicity and quality grades beside plain Python: hashes, ratios, likelihoods and the scores of every document."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentilode.llm import ngrams, ordinal, toxicity

SF = "/root/testdata/sf0.001"
ALL = (1 << 64) - 1


def grams(text: str | None, lengths, bits: int) -> Counter:
    """The feature of every n-gram with its count, one n-gram at a time."""
    plain = f" {text or ''} ".lower()
    for c in "\t\n\x0b\x0c\r":
        plain = plain.replace(c, " ")
    found: Counter = Counter()
    for n in lengths:
        for start in range(len(plain) - n + 1):
            h = 0
            for c in plain[start:start + n]:
                h = (h * int(ngrams._BASE) + ord(c)) & ALL
            h = (h + n * ngrams._SIZE) & ALL
            h ^= h >> 29
            found[(h * int(ngrams._MIX) & ALL) >> (64 - bits)] += 1
    return found


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -500 else 0.0


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


LABELLED = [
    ("you are awful, awful people", 1, 0), ("awful people\nall of you", 1, 1), ("such awful stuff", 1, 2), ("Awful!", 1, 0),
    ("a fine day in the park", 0, 0), ("the park is fine today", 0, 1), ("people like the park", 0, 2), ("", 0, 0), ("a fine day", 0, 1),
]


def test_toxicity_ratios(spark):
    """Counts by label and fold and log-count ratios of all features, with and without those that tell little."""
    bits, lengths = 20, (4, 5, 6, 7)
    sets = [set(grams(text, lengths, bits)) for text, _, _ in LABELLED]
    rows = spark.createDataFrame(LABELLED, "text string, label int, fold int").repartition(3)
    ones = sum(label for _, label, _ in LABELLED)
    zeros = len(LABELLED) - ones
    for least, low in ((1, 0.0), (2, 0.4)):
        want = {}
        for f in set().union(*sets):
            n1 = sum(f in s for s, (_, label, _) in zip(sets, LABELLED) if label == 1)
            n0 = sum(f in s for s, (_, label, _) in zip(sets, LABELLED) if label == 0)
            ratio = math.log(((n1 * (ones + zeros) / ones) + 2.0) / ((n0 * (ones + zeros) / zeros) + 2.0))
            if n1 + n0 >= least and abs(ratio) >= low:
                want[f] = ratio
        found = toxicity.feature_counts(rows, lengths, bits, 2.0, least, low).toPandas()
        own = found[found.feature >= 0]
        assert set(own.feature) == set(want)
        for row in own.itertuples():
            for label in (0, 1):
                for fold in range(toxicity.FOLDS):
                    n = sum(row.feature in s for s, (_, y, k) in zip(sets, LABELLED) if (y, k) == (label, fold))
                    assert getattr(row, f"n{label}_{fold}") == n
        n1, n0 = (sum(found[f"n{y}_{k}"].to_numpy() for k in range(toxicity.FOLDS)) for y in (1, 0))
        ratios = toxicity.log_count_ratios(found.feature.to_numpy(), n1, n0, bits, 2.0, least, low)
        assert {int(f) for f in np.flatnonzero(ratios)} == {f for f, r in want.items() if r}
        assert all(ratios[f] == pytest.approx(r) for f, r in want.items())


def test_toxicity_weights_are_the_optimum():
    """The fitted margins are those of plain gradient descent on the written-out loss."""
    draw = np.random.default_rng(3)
    n, size, penalty = 60, 25, 1e-2
    found = [np.flatnonzero(draw.random(size) < 0.3) for _ in range(n)]
    found = [f if len(f) else np.array([0]) for f in found]
    labels = (np.array([len(f) + 4 * (3 in f) for f in found]) + draw.normal(size=n) > 9).astype(np.float64)
    ratio = draw.normal(size=size)
    x = np.zeros((n, size))
    for k, f in enumerate(found):
        x[k, f] = ratio[f] / np.sqrt((ratio[f] ** 2).sum())
    part = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))
    w, b = np.zeros(size), 0.0
    for _ in range(40_000):
        error = (1 / (1 + np.exp(-(x @ w + b))) - labels) * part
        w, b = w - 1.0 * (x.T @ error + penalty * w), b - error.sum()
    got = toxicity.fit_linear(found, labels, ratio, penalty, 3_000)
    assert got == pytest.approx(w * ratio, abs=1e-4)
    assert toxicity.margins(found, got, ratio) == pytest.approx(x @ w, abs=1e-3)


def test_toxicity_scores_of_every_document(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    # So few texts that a real model has hardly a feature: a made-up one over half of all features.
    learned = toxicity.train(documents, labels, steps=10)
    draw = np.random.default_rng(5)
    used = np.sort(draw.choice(1 << 20, 1 << 19, replace=False)).astype(np.int32)
    made = learned | {
        "used": used, "ratio": draw.normal(size=len(used)).astype(np.float32),
        "weights": draw.normal(size=len(used)).astype(np.float32), "slope": 1.5, "shift": -0.25,
    }
    rows = {r.doc_id: r.text for r in documents.collect() if len(r.text or "") < 3_000}
    for model in (learned, made):
        place = {int(f): k for k, f in enumerate(model["used"])}
        got = {r.doc_id: r.score for r in toxicity.score(documents, model).collect()}
        assert len(got) == documents.count() and len(rows) > 100
        for doc_id, text in rows.items():
            known = [place[f] for f in grams(text, model["lengths"], model["bits"]) if f in place]
            length = math.sqrt(sum(float(model["ratio"][k]) ** 2 for k in known))
            margin = sum(float(model["weights"][k]) for k in known) / max(length, 1e-12)
            assert got[doc_id] == pytest.approx(sigmoid(model["slope"] * margin + model["shift"]), rel=1e-9)


def negative_likelihood(found, grades, penalty, w, cuts) -> float:
    """The mean of -log P(grade), written out per row, and the penalty."""
    total = 0.0
    for (feature, value), grade in zip(found, grades):
        margin = sum(float(v) * w[f] for f, v in zip(feature, value))
        over = [1.0, *[sigmoid(margin - c) for c in cuts], 0.0]
        total -= math.log(over[grade] - over[grade + 1])
    return total / len(grades) + penalty / 2 * float((w * w).sum())


def test_ordinal_fit_is_the_optimum():
    """No small change of a weight or a threshold makes the written-out likelihood better."""
    draw = np.random.default_rng(11)
    n, size, penalty = 80, 6, 1e-2
    found = []
    for _ in range(n):
        feature = np.sort(draw.choice(size, 3, replace=False))
        value = draw.random(3)
        found.append((feature, value / np.sqrt((value * value).sum())))
    margin = np.array([sum(v * (f - 2.5) for f, v in zip(*row)) for row in found])
    grades = np.searchsorted([-1.0, 1.0], margin + draw.logistic(size=n))
    assert set(grades) == {0, 1, 2}
    w, cuts = ordinal.fit_ordinal(found, grades, 3, size, penalty, 4_000)
    best = negative_likelihood(found, grades, penalty, w, cuts)
    for k in range(size + 2):
        slopes = []
        for step in (-1e-4, 1e-4):
            w2, cuts2 = w.copy(), cuts.copy()
            (w2 if k < size else cuts2)[k if k < size else k - size] += step
            slopes.append((negative_likelihood(found, grades, penalty, w2, cuts2) - best) / 1e-4)
        assert abs(slopes[1] - slopes[0]) / 2 < 1e-4 and min(slopes) > -1e-4
    start = negative_likelihood(found, grades, penalty, np.zeros(size), ordinal.fit_ordinal([], np.array([], np.int64), 3, size, penalty, 1)[1])
    assert best < start - 0.05


def test_ordinal_grades_of_every_document(spark, documents):
    graded = ordinal.grades_of(spark.read.parquet(f"{SF}/labels.parquet"))
    model = ordinal.train(documents, graded, steps=40)
    assert model["weights"].any() and (np.diff(model["cuts"]) > 0).all()
    got = {r.doc_id: r for r in ordinal.grade(documents, model).collect()}
    assert len(got) == documents.count()
    rows = {r.doc_id: r.text for r in documents.filter(F.length("text") < 3_000).collect()}
    for doc_id, text in rows.items():
        value = {f: math.log1p(n) for f, n in grams(text, model["lengths"], model["bits"]).items()}
        length = math.sqrt(sum(v * v for v in value.values()))
        margin = sum(v * float(model["weights"][f]) for f, v in value.items()) / max(length, 1e-12)
        over = [sigmoid(margin - c) for c in model["cuts"]]
        assert got[doc_id].expected_grade == pytest.approx(sum(over), rel=1e-9)
        assert got[doc_id].tail_probability == pytest.approx(over[0], rel=1e-9)
        assert got[doc_id].kept == (over[0] >= 0.5)
