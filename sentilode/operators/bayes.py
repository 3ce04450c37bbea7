"""Multinomial naive Bayes over TF-IDF weights as aggregates and one join."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.operators.features import VOCABULARY_SIZE, idf_weight, known_rows, term_rows, term_stats
from sentilode.operators.scale import lookup_join, top_k
from sentilode.session import materialize


def _log(value: Column) -> Column:
    """ln, with minus infinity (not null) at zero."""
    return F.when(value > 0, F.log(value)).otherwise(F.lit(float("-inf")))


@dataclass(frozen=True)
class BayesModel:
    """Parameters of one or more views of the training rows.

    A view is all rows, or all rows but one fold. `terms` has one row per term:
    `views` holds per view the idf and the theta of each (smoothing, class), or
    null where the view's vocabulary lacks the term.
    """

    terms: DataFrame
    priors: list[list[float]]
    smoothings: tuple[float, ...]
    classes: tuple[int, ...]

    def parameters(self, view: int = 0) -> DataFrame:
        """(smoothing, label, term, idf, theta)"""
        cells = [
            F.struct(
                F.lit(s).alias("smoothing"),
                F.lit(c).alias("label"),
                F.get("theta", F.lit(i * len(self.classes) + j)).alias("theta"),
            )
            for i, s in enumerate(self.smoothings)
            for j, c in enumerate(self.classes)
        ]
        known = self.terms.select("term", F.get("views", F.lit(view)).alias("v")).filter("v is not null")
        return known.select("term", "v.idf", "v.theta").select(
            "term", "idf", F.inline(F.array(*cells))
        )

    def score(self, counted: DataFrame, *keep: str, view: str | None = None) -> DataFrame:
        """(keep, smoothing, raw, prediction), a row per document and smoothing.

        `keep` must identify the document. Its terms lie in one task, so the
        sums are complete before the shuffle. Unknown terms are ignored; a
        document without a known term gets the prior.
        """
        cells = len(self.smoothings) * len(self.classes)
        per_term = len(self.priors) * 8 * (cells + 8)
        rows = lookup_join(
            term_rows(counted, *keep), self.terms, "term", array_bytes=per_term
        )
        at = F.col(view) if view else F.lit(0)
        v = F.get("views", at)
        rows = rows.select(*keep, "tf", v["idf"].alias("idf"), v["theta"].alias("theta"))
        # A weight of zero adds nothing, whatever theta is.
        parts = [
            F.sum(
                F.when(F.col("idf") != 0, F.col("tf") * F.col("idf") * F.get("theta", F.lit(i)))
            ).alias(f"s{i}")
            for i in range(cells)
        ]
        sums = rows.groupBy(*keep).agg(*parts)
        priors = F.array(*[F.array(*map(F.lit, p)) for p in self.priors])
        prior = F.get(priors, at)
        raw = [F.get(prior, F.lit(i)) + F.coalesce(f"s{i}", F.lit(0.0)) for i in range(cells)]
        width = len(self.classes)
        per_smoothing = F.array(
            *[
                F.struct(
                    F.lit(s).alias("smoothing"), F.array(*raw[i * width : (i + 1) * width]).alias("raw")
                )
                for i, s in enumerate(self.smoothings)
            ]
        )
        best = F.array_position("raw", F.array_max("raw")).cast("int")
        return (
            sums.select(*keep, F.inline(per_smoothing))
            .withColumn("prediction", F.element_at(F.array(*map(F.lit, self.classes)), best))
        )


def fit(
    counted: DataFrame,
    label: str = "label",
    smoothings: Sequence[float] = (1.0,),
    classes: Sequence[int] = (0, 1),
    fold: str | None = None,
    folds: int = 0,
    vocabulary_size: int = VOCABULARY_SIZE,
    corpus: DataFrame | None = None,
) -> BayesModel:
    """Learn from rows with `terms` and a label.

    With a fold column one model per fold is learned, from the rows outside
    it: the counts of a fold are taken off the totals, so the documents are
    read once whatever the number of folds. With `corpus` the vocabulary and
    the idf come from those documents instead of the training rows, for
    every fold; the class counts stay those of the fold's training rows.
    Rows whose label is not one of `classes` teach nothing.
    """
    counted = counted.filter(F.col(label).isin(list(classes)))
    views = list(range(folds)) if fold else [None]
    smoothings, classes = tuple(float(s) for s in smoothings), tuple(classes)
    is_class = [F.col(label) == c for c in classes]
    tf = F.col("tf")

    def total(value: Column, condition: Column | None) -> Column:
        return F.coalesce(F.sum(value if condition is None else F.when(condition, value)), F.lit(0))

    # Documents per class and view.
    sizes = (
        counted.groupBy(F.col(label).alias("label"), *([F.col(fold).alias("fold")] if fold else []))
        .agg(F.count("*").alias("n"))
        .collect()  # classes x folds
    )
    of_class = [
        [
            sum(r["n"] for r in sizes if r["label"] == c and (v is None or r["fold"] != v))
            for c in classes
        ]
        for v in views
    ]
    documents = [sum(n) for n in of_class]

    # Counts per term: of all rows, and of each fold.
    aggregates = [F.count("*").alias("df")]
    aggregates += [total(tf, k).alias(f"tf_{j}") for j, k in enumerate(is_class)]
    for v in views if fold else []:
        inside = F.col(fold) == v
        aggregates.append(total(F.lit(1), inside).alias(f"df_in{v}"))
        aggregates += [
            total(tf, inside & k).alias(f"tf_{j}_in{v}") for j, k in enumerate(is_class)
        ]
    kept = [label] + ([fold] if fold else [])
    stats = materialize(
        known_rows(counted, *kept).groupBy("term").agg(*aggregates), "bayes-counts"
    )
    if corpus is not None:
        stats = term_stats(corpus).join(stats.drop("df"), "term", "left").na.fill(0)
        documents = [corpus.count()] * len(views)

    def of(v: int | None, column: str) -> Column:
        return F.col(column) if v is None else F.col(column) - F.col(f"{column}_in{v}")

    columns = []
    for i, v in enumerate(views):
        counts = [of(v, f"tf_{j}") for j in range(len(classes))]
        seen = F.col("cf") if corpus is not None else sum(counts[1:], counts[0])
        columns += [
            (F.col("df") if corpus is not None else of(v, "df")).alias(f"df{i}"),
            seen.alias(f"cf{i}"),
            *[c.alias(f"n{i}_{j}") for j, c in enumerate(counts)],
        ]
    stats = stats.select("term", *columns)
    if corpus is not None:
        stats = materialize(stats, "bayes-corpus-counts")

    weight = [idf_weight(F.col(f"df{i}"), F.lit(documents[i])) for i in range(len(views))]

    def sums(member: Sequence[Column]):
        """Size of each view's vocabulary, and its weight per class."""
        return stats.agg(
            *[F.count_if(m).alias(f"v{i}") for i, m in enumerate(member)],
            *[
                F.coalesce(F.sum(F.when(m, weight[i] * F.col(f"n{i}_{j}"))), F.lit(0.0)).alias(f"w{i}_{j}")
                for i, m in enumerate(member)
                for j in range(len(classes))
            ],
        ).first()

    # The vocabulary of each view; a larger one is cut by count and then by term.
    member = [F.col(f"df{i}") > 0 for i in range(len(views))]
    totals = sums(member)
    larger = [i for i in range(len(views)) if totals[f"v{i}"] > vocabulary_size]
    for i in larger:
        cf = F.col(f"cf{i}")
        kept_terms = top_k(stats.filter(member[i]), vocabulary_size, cf, [cf.desc(), F.col("term")])
        last = kept_terms.orderBy(cf, F.desc("term")).first()
        edge = last[f"cf{i}"]
        member[i] &= (cf > edge) | ((cf == edge) & (F.col("term") <= last["term"]))
    if larger:
        totals = sums(member)

    def theta(i: int, smoothing: float, j: int) -> Column:
        below = totals[f"w{i}_{j}"] + totals[f"v{i}"] * smoothing
        return _log(weight[i] * F.col(f"n{i}_{j}") + smoothing) - _log(F.lit(below))

    per_view = [
        F.when(
            m,
            F.struct(
                weight[i].alias("idf"),
                F.array(
                    *[theta(i, s, j) for s in smoothings for j in range(len(classes))]
                ).alias("theta"),
            ),
        )
        for i, m in enumerate(member)
    ]
    terms = stats.filter(_any(member)).select("term", F.array(*per_view).alias("views"))

    def log(x: float) -> float:
        return math.log(x) if x > 0 else -math.inf

    priors = [
        [log(n + s) - log(sum(ns) + len(classes) * s) for s in smoothings for n in ns]
        for ns in of_class
    ]
    return BayesModel(materialize(terms, "bayes-terms"), priors, smoothings, classes)


def _any(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found


def grid_accuracy(scored: DataFrame, label: str = "label", fold: str = "fold") -> DataFrame:
    """(smoothing, accuracy, best): the mean over folds; the first best smoothing wins."""
    per_fold = scored.groupBy("smoothing", fold).agg(
        F.avg((F.col("prediction") == F.col(label)).cast("int")).alias("a")
    )
    mean = per_fold.groupBy("smoothing").agg(F.avg("a").alias("accuracy"))
    mean = materialize(mean, "grid")  # one row per smoothing
    top = max(mean.collect(), key=lambda r: (r["accuracy"], -r["smoothing"]))
    return mean.withColumn("best", F.col("smoothing") == top["smoothing"])
