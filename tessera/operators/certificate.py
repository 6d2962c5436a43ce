"""Certificates of fitted linear models: one distributed aggregate at the fitted coefficients.

The objective of the estimators is the mean loss of a row plus an elastic-net penalty on the
coefficients of standardised features (``scaled`` = coefficient x the feature's standard
deviation; the intercept is free). It is convex, so a fitted model is the optimum exactly when
zero lies in its subdifferential. The aggregate sums, for every coefficient, the rows' loss
gradients with ``Summarizer`` (vectors stay vectors, so wide and sparse features work), and the
losses at the model, at models scaled a little down and up, and without features.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative step of the perturbed models, and the distance from the hinge's kink that leaves a
#: row's subgradient open.
STEP, KINK = 0.1, 0.005


@dataclass
class Certificate:
    """``violation``: the largest distance from zero to the subdifferential over all coefficients,
    0 at the optimum; ``coefficients``: (class_id, feature, value, scaled), feature -1 the
    intercept at the original and at the centred features (of several classes they add up to 0)."""

    n: int
    objective: float
    null_objective: float
    perturbed: list[float]
    violation: float
    coefficients: list[tuple[int, int, float, float]] = field(repr=False)

    def optimal(self, tolerance: float) -> bool:
        return self.violation <= tolerance

    @property
    def below_null(self) -> bool:
        return self.objective <= self.null_objective

    @property
    def below_perturbed(self) -> bool:
        return all(self.objective <= p for p in self.perturbed)


def _parameters(model) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(model, LinearSVCModel):
        return model.coefficients.toArray()[None, :], np.array([model.intercept])
    return model.coefficientMatrix.toArray(), model.interceptVector.toArray()


def _log1pexp(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def certify_linear(rows: DataFrame, model, reg: float, elastic_net: float = 0.0, label: str = "label",
                   features: str = "features") -> Certificate:
    """The certificate of a ``LogisticRegressionModel`` or ``LinearSVCModel`` over the rows it was
    fitted on. ``reg`` and ``elastic_net`` are the fit's. Rows whose label is null are left out."""
    weights, intercepts = _parameters(model)
    k, hinge = len(weights), isinstance(model, LinearSVCModel)
    scored = model.transform(rows.filter(F.col(label).isNotNull()))
    raw, y = vector_to_array("rawPrediction"), F.col(label)
    margin = [raw[1]] if k == 1 else [raw[c] for c in range(k)]

    def loss(m: list[Column]) -> Column:
        if hinge:
            return F.greatest(F.lit(0.0), 1.0 - (2.0 * y - 1.0) * m[0])
        if k == 1:
            return _log1pexp(m[0]) - y * m[0]
        top = F.greatest(*m)
        return top + F.log(sum((F.exp(v - top) for v in m[1:]), F.exp(m[0] - top))) - F.get(F.array(*m), y.cast("int"))

    def scaled(s: float) -> list[Column]:
        return [(v - float(b)) * s + float(b) for v, b in zip(margin, intercepts)]

    if hinge:
        sign = 2.0 * y - 1.0
        slope = [F.when(sign * margin[0] < 1.0, -sign).otherwise(0.0)]
        near = F.when(F.abs(1.0 - sign * margin[0]) <= KINK, 1.0).otherwise(0.0)
    elif k == 1:
        slope = [1.0 / (1.0 + F.exp(-margin[0])) - y]
    else:
        top = F.greatest(*margin)
        total = sum((F.exp(v - top) for v in margin[1:]), F.exp(margin[0] - top))
        slope = [F.exp(v - top) / total - (y == c).cast("double") for c, v in enumerate(margin)]
    x, shift = F.col(features), 2.0  # weights must be positive: slope + 2, minus twice the plain sum
    picked = scored.select(x.alias("x"), y.alias("y"), loss(margin).alias("loss"), loss(scaled(1 - STEP)).alias("down"),
                           loss(scaled(1 + STEP)).alias("up"), *[(s + shift).alias(f"s{c}") for c, s in enumerate(slope)],
                           *([(near + 1.0).alias("near")] if hinge else []))
    sums = picked.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("loss", "down", "up")],
                      Summarizer.metrics("mean", "std", "normL1").summary(F.col("x")).alias("plain"),
                      *[Summarizer.metrics("mean").summary(F.col("x"), F.col(f"s{c}")).alias(f"g{c}") for c in range(k)],
                      *[F.sum(f"s{c}").alias(f"w{c}") for c in range(k)],
                      *([Summarizer.metrics("normL1").summary(F.col("x"), F.col("near")).alias("open"),
                         (F.sum("near") - F.count(F.lit(1))).alias("n_open")] if hinge else [])).first()
    counts = picked.groupBy("y").agg(F.count(F.lit(1)).alias("c")).collect()  # one row per class
    n, mean, std = sums["n"], sums["plain"]["mean"].toArray(), sums["plain"]["std"].toArray()
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    l1, l2 = reg * elastic_net, reg * (1.0 - elastic_net)
    v = weights * std

    def penalty(s: float) -> float:
        return float(l1 * np.abs(v * s).sum() + l2 / 2 * ((v * s) ** 2).sum())

    violation, cells = 0.0, []
    for c in range(k):
        gradient = (sums[f"g{c}"]["mean"].toArray() * sums[f"w{c}"] - shift * n * mean) / n
        free = sums[f"w{c}"] / n - shift
        gradient = (gradient - free * mean) * inverse  # of the centred, scaled feature
        slack, slack_free = np.zeros_like(v[c]), 0.0
        if hinge:
            slack_free = sums["n_open"] / n
            opened = (sums["open"]["normL1"].toArray() - sums["plain"]["normL1"].toArray()) / n
            slack = (opened + slack_free * np.abs(mean)) * inverse
        total = gradient + l2 * v[c]
        away = np.where(v[c] != 0, np.abs(total + l1 * np.sign(v[c])), np.maximum(np.abs(total) - l1, 0)) - slack
        violation = max(violation, float(away[std > 0].max(initial=0.0)), abs(free) - slack_free)
        cells += [(c, j, float(w), float(s)) for j, (w, s) in enumerate(zip(weights[c], v[c]))]
    centred = intercepts + weights @ mean
    base, base_centred = (intercepts.mean(), centred.mean()) if k > 1 else (0.0, 0.0)  # of no effect: the classes compete
    cells += [(c, -1, float(intercepts[c] - base), float(centred[c] - base_centred)) for c in range(k)]
    share = np.array([r["c"] for r in counts], float) / n
    null = 2 * min(share.min(), 1 - share.min()) if hinge else float(-(share * np.log(share)).sum())
    return Certificate(n, sums["loss"] / n + penalty(1.0), float(null) if len(share) > 1 else 0.0,
                       [sums["down"] / n + penalty(1 - STEP), sums["up"] / n + penalty(1 + STEP)], violation, cells)
