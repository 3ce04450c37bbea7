"""How far a linear model can be from the optimum, from sums over the training rows.

The solvers minimise the mean loss plus a penalty on the coefficients of scaled features (each divided by its standard
deviation, as the solvers do it). What is recomputed here by joins, from nothing but coefficients and feature entries:

* the objective, which must be what the solver says it reached;
* the duality gap: labels and margins give a feasible point of the dual problem, whose value no model can go below. The gap between both bounds what any
  better model could gain. With other coefficients than the optimum's it is larger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.operators.scale import lookup_join
from sentilode.session import materialize


@dataclass
class Certificate:
    """Objective of the model, the largest lower bound known for all models, and the largest slope of the intercept."""

    objective: float
    lower_bound: float
    intercept_slope: float

    @property
    def gap(self) -> float:
        return self.objective - self.lower_bound


def feature_scales(entries: DataFrame, n_rows: int) -> DataFrame:
    """(index, sd): the standard deviation of each feature, zeros included, as the solvers scale by it (n - 1)."""
    sums = entries.groupBy("index").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    variance = (F.col("q") - F.col("s") * F.col("s") / n_rows) / max(n_rows - 1, 1)
    return sums.select("index", F.sqrt(F.greatest(variance, F.lit(0.0))).alias("sd")).filter("sd > 0")


def margins(entries: DataFrame, rows: DataFrame, coefficients: DataFrame, intercept: float, key: str = "doc_id") -> DataFrame:
    """(key, label, margin) of every row."""
    products = lookup_join(entries, coefficients, "index", "inner")
    sums = products.groupBy(key).agg(F.sum(F.col("value") * F.col("coefficient")).alias("sum"))
    return rows.join(sums, key, "left").select(key, "label", (F.coalesce("sum", F.lit(0.0)) + intercept).alias("margin"))


def _hinge(margin: Column, sign: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - sign * margin)


def _logistic(margin: Column, sign: Column) -> Column:
    at = -sign * margin
    return F.greatest(at, F.lit(0.0)) + F.log1p(F.exp(-F.abs(at)))


def certify(
    entries: DataFrame,
    rows: DataFrame,
    coefficients: DataFrame,
    intercept: float,
    loss: str,
    penalty: float,
    l1_share: float = 0.0,
    key: str = "doc_id",
) -> Certificate:
    """The certificate of a model on its training rows: `entries` (key, index, value), `rows` (key, label), `coefficients` (index, coefficient).

    `loss` is `hinge` or `logistic`. Let a row's slope be the derivative of its loss by its margin (for the hinge 0 or -1 times the sign). Slopes
    that add up to zero over all rows are a feasible dual point, since the intercept is free; those of one label are scaled down to make them so.
    Penalty p, split in shares of L1 (a) and L2 (1 - a), bounds the dual from the weighted sums g of each scaled feature:
    the mean conjugate loss and max(|g| - p a, 0) ** 2 / (2 p (1 - a)) are what the lower bound subtracts. Without an L2 part a point is only feasible
    with |g| <= p a, so slopes are scaled to that; without any penalty no bound but 0 is known.
    """
    n = rows.count()
    scaled = margins(entries, rows, coefficients, intercept, key)
    sign = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    if loss == "hinge":
        # Inside the corner any slope is one of the loss; the end of it is.
        slope = F.when(sign * F.col("margin") < 1, 1.0).otherwise(0.0)
        value = _hinge(F.col("margin"), sign)
    else:
        slope = 1 / (1 + F.exp(sign * F.col("margin")))
        value = _logistic(F.col("margin"), sign)
    told = materialize(scaled.select(key, "label", sign.alias("sign"), slope.alias("slope"), value.alias("loss")), "certificate-rows")
    sums = {r["sign"]: r["s"] for r in told.groupBy("sign").agg(F.sum("slope").alias("s")).collect()}
    mean = told.agg(F.avg("loss")).first()[0] or 0.0
    up, down = sums.get(1.0, 0.0), sums.get(-1.0, 0.0)
    even = min(up, down)
    share = F.when(F.col("sign") > 0, F.lit(even / up if up else 0.0)).otherwise(F.lit(even / down if down else 0.0))
    told = told.withColumn("slope", F.col("slope") * share)
    scales = materialize(feature_scales(entries, n), "certificate-scales")
    weighted = (
        entries.join(told.select(key, (F.col("slope") * F.col("sign")).alias("pull")), key)
        .groupBy("index").agg((F.sum(F.col("value") * F.col("pull")) / n).alias("g"))
        .join(scales, "index").select("index", (F.col("g") / F.col("sd")).alias("g"))
    )
    weighted = materialize(weighted, "certificate-sums")
    size = coefficients.join(scales, "index").select((F.col("coefficient") * F.col("sd")).alias("w"))
    norms = size.agg(F.sum(F.abs("w")).alias("one"), F.sum(F.col("w") * F.col("w")).alias("two")).first()
    ridge, lasso = penalty * (1 - l1_share), penalty * l1_share
    objective = mean + lasso * (norms["one"] or 0.0) + ridge / 2 * (norms["two"] or 0.0)
    slope_of_intercept = abs(up - down) / n if n else 0.0
    if not ridge and not lasso:
        return Certificate(objective, 0.0, slope_of_intercept)
    most = weighted.agg(F.max(F.abs("g"))).first()[0] or 0.0
    shrink = min(1.0, lasso / most) if not ridge and most else 1.0
    over = F.greatest(F.abs(F.col("g") * shrink) - lasso, F.lit(0.0))
    dual = (weighted.agg(F.sum(over * over)).first()[0] or 0.0) / (2 * ridge) if ridge else 0.0
    a = F.col("slope") * shrink
    if loss == "hinge":
        gain = a
    else:
        # The entropy of a slope between 0 and 1.
        inside = (a > 0) & (a < 1)
        gain = F.when(inside, -a * F.log(a) - (1 - a) * F.log1p(-a)).otherwise(0.0)
    gained = told.agg(F.avg(gain)).first()[0] or 0.0
    return Certificate(objective, max(0.0, gained - dual), slope_of_intercept)
