"""Two-class linear models by Newton steps, with a certificate of how near the optimum is.

Equal rows are first grouped to one weighted row, written once; each step is then
one aggregate of (d + 1)(d + 2) / 2 sums (d features) and one of the loss at six
step lengths.  Only these sums reach the driver, which solves one
(d + 1)-square system; meant for up to some tens of features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.operators.stats import materialize

STEP_LENGTHS = tuple(4.0 ** -i for i in range(6))
#: Widths of the rounded hinge, each fit starting from the one before; the gap is at most a quarter of the last.
HINGE_WIDTHS = (1.0, 0.1, 0.01)


@dataclass(frozen=True)
class LinearFit:
    """``weights`` (constant first) of the standardised features; ``means``, ``scales`` undo that."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    n: int
    losses: tuple[float, ...]

    def margin(self) -> Column:
        """The score of a row with the feature columns; above 0: the positive class."""
        terms = [(F.col(f"`{c}`").try_cast("double") - m) / s * w
                 for c, m, s, w in zip(self.features, self.means, self.scales, self.weights[1:])]
        return sum(terms, F.lit(self.weights[0]))


def _grouped(df: DataFrame, features: Sequence[str], positive: Column):
    """Weighted distinct rows ``x0..xd, y, w`` (y: 1 or -1; x0: 1), standardised, and what undoes it."""
    read = df.select(*[F.col(f"`{c}`").try_cast("double").alias(f"x{i + 1}") for i, c in enumerate(features)],
                     F.when(positive, 1.0).when(~positive, -1.0).alias("y"))
    names = [f"x{i + 1}" for i in range(len(features))]
    usable = F.col("y").isNotNull()
    for c in names:
        usable = usable & (F.abs(c) < float("inf"))
    rows = materialize(read.filter(usable).groupBy(*names, "y").agg(F.count("*").cast("double").alias("w")))
    w = F.col("w")
    first = rows.agg(F.sum(w).alias("n"), *[(F.sum(w * F.col(c)) / F.sum(w)).alias(c) for c in names]).first()
    if not first["n"]:
        return None
    means = [first[c] for c in names]
    spread = rows.agg(*[F.sqrt(F.sum(w * (F.col(c) - m) * (F.col(c) - m)) / F.sum(w)).alias(c)
                        for c, m in zip(names, means)]).first()
    scales = [spread[c] or 1.0 for c in names]
    points = rows.select(F.lit(1.0).alias("x0"), *[((F.col(c) - m) / s).alias(c) for c, m, s in zip(names, means, scales)],
                         "y", "w")
    return points, means, scales, first["n"]


def _signed_margin(weights) -> Column:
    return F.col("y") * sum((F.col(f"x{j}") * float(v) for j, v in enumerate(weights)), F.lit(0.0))


def _logistic(t: Column):
    """Loss, its falling slope (0 to 1) and its curvature at the signed margin ``t``."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(t))
    return F.greatest(-t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t))), p, p * (F.lit(1.0) - p)


def _rounded_hinge(width: float):
    def parts(t: Column):
        u = F.lit(1.0) - t
        slope = F.greatest(F.lit(0.0), F.least(F.lit(1.0), u / width))
        loss = F.when(u <= 0, 0.0).when(u >= width, u - width / 2).otherwise(u * u / (2 * width))
        return loss, slope, F.when((u > 0) & (u < width), 1.0 / width).otherwise(0.0)
    return parts


def _newton(points: DataFrame, start, n: float, ridge: float, parts, rounds: int, tolerance: float):
    """Damped Newton from ``start``: weights and the objective of every round."""
    weights, d, losses = np.array(start, float), len(start), []
    upper = [(j, k) for j in range(d) for k in range(j, d)]
    for _ in range(rounds):
        loss, slope, curve = parts(F.col("t"))
        at = points.withColumn("t", _signed_margin(weights)).select(
            "*", loss.alias("loss"), slope.alias("slope"), curve.alias("curve"))
        sums = at.agg(F.sum(F.col("w") * F.col("loss")).alias("loss"),
                      *[F.sum(-F.col("w") * F.col("slope") * F.col("y") * F.col(f"x{j}")).alias(f"g{j}") for j in range(d)],
                      *[F.sum(F.col("w") * F.col("curve") * F.col(f"x{j}") * F.col(f"x{k}")).alias(f"h{j}_{k}")
                        for j, k in upper]).first()
        losses.append(sums["loss"] / n + ridge / 2 * float(weights @ weights))
        gradient = np.array([sums[f"g{j}"] for j in range(d)]) / n + ridge * weights
        if np.linalg.norm(gradient) <= tolerance:
            break
        hessian = ridge * np.eye(d)
        for j, k in upper:
            hessian[j, k] += sums[f"h{j}_{k}"] / n
            hessian[k, j] = hessian[j, k]
        move = np.linalg.solve(hessian, -gradient)
        tried = [weights + s * move for s in STEP_LENGTHS]
        totals = points.agg(*[F.sum(F.col("w") * parts(_signed_margin(v))[0]).alias(f"l{i}")
                              for i, v in enumerate(tried)]).first()
        values = [totals[i] / n + ridge / 2 * float(v @ v) for i, v in enumerate(tried)]
        best = int(np.argmin(values))
        if values[best] >= losses[-1] and np.linalg.norm(gradient) <= 1e-6:
            weights = tried[0]  # rounding hides the gain: the full step still halves the gradient
        elif values[best] >= losses[-1]:
            break
        else:
            weights = tried[best]
    return weights, losses


def _empty(features) -> tuple[LinearFit, dict]:
    d = len(features)
    fit = LinearFit(tuple(features), (0.0,) * (d + 1), (0.0,) * d, (1.0,) * d, 0, ())
    return fit, {"gradient_norm": 0.0, "primal": 0.0, "dual": 0.0, "gap": 0.0}


def logistic_regression(df: DataFrame, features: Sequence[str], positive: Column, ridge: float = 1e-3,
                        rounds: int = 50) -> tuple[LinearFit, dict]:
    """Logistic regression (mean loss + ``ridge`` / 2 |weights|^2, the constant's too) and its certificate.

    ``gradient_norm`` is the length of the objective's gradient at the weights
    returned, summed anew over all rows; the objective curves by at least
    ``ridge``, so the weights are within ``gradient_norm / ridge`` of the
    optimum.  Rows with an unreadable, null or infinite feature or a null class
    are left out; no rows at all give zero weights and ``n`` 0.
    """
    grouped = _grouped(df, features, positive)
    if grouped is None:
        return _empty(features)
    points, means, scales, n = grouped
    d = len(features) + 1
    weights, losses = _newton(points, np.zeros(d), n, ridge, _logistic, rounds, 1e-10)
    slope = _logistic(F.col("t"))[1]
    sums = points.withColumn("t", _signed_margin(weights)).withColumn("slope", slope).agg(
        *[F.sum(-F.col("w") * F.col("slope") * F.col("y") * F.col(f"x{j}")).alias(f"g{j}") for j in range(d)]).first()
    gradient = np.array([sums[f"g{j}"] for j in range(d)]) / n + ridge * weights
    fit = LinearFit(tuple(features), tuple(map(float, weights)), tuple(means), tuple(scales), int(n), tuple(losses))
    return fit, {"gradient_norm": float(np.linalg.norm(gradient))}


def linear_svm(df: DataFrame, features: Sequence[str], positive: Column, ridge: float = 1e-2,
               rounds: int = 60) -> tuple[LinearFit, dict]:
    """Support vector machine (mean hinge loss + ``ridge`` / 2 |weights|^2) and its duality gap.

    The hinge is rounded over a width that shrinks from fit to fit
    (``HINGE_WIDTHS``).  The rounded hinge's slopes are feasible dual values, so
    one aggregate over all rows gives ``primal`` (with the true hinge), ``dual``
    and their difference ``gap``: the objective is within ``gap`` of the best.
    Odd rows: as in :func:`logistic_regression`.
    """
    grouped = _grouped(df, features, positive)
    if grouped is None:
        return _empty(features)
    points, means, scales, n = grouped
    d = len(features) + 1
    weights, losses = np.zeros(d), []
    for width in HINGE_WIDTHS:  # the gap is measured, so only the last fit has to be close
        tolerance = 1e-8 if width == HINGE_WIDTHS[-1] else 1e-3
        weights, steps = _newton(points, weights, n, ridge, _rounded_hinge(width), rounds, tolerance)
        losses += steps
    slope = _rounded_hinge(HINGE_WIDTHS[-1])(F.col("t"))[1]
    sums = points.withColumn("t", _signed_margin(weights)).withColumn("slope", slope).agg(
        F.sum(F.col("w") * F.greatest(F.lit(0.0), 1.0 - F.col("t"))).alias("hinge"),
        F.sum(F.col("w") * F.col("slope")).alias("slopes"),
        *[F.sum(F.col("w") * F.col("slope") * F.col("y") * F.col(f"x{j}")).alias(f"v{j}") for j in range(d)]).first()
    of_dual = np.array([sums[f"v{j}"] for j in range(d)]) / (ridge * n)
    primal = sums["hinge"] / n + ridge / 2 * float(weights @ weights)
    dual = sums["slopes"] / n - ridge / 2 * float(of_dual @ of_dual)
    fit = LinearFit(tuple(features), tuple(map(float, weights)), tuple(means), tuple(scales), int(n), tuple(losses))
    return fit, {"primal": primal, "dual": dual, "gap": primal - dual}


def one_against_rest(df: DataFrame, features: Sequence[str], label: str, classes: Sequence[str], fit=linear_svm) -> dict:
    """``class -> (fit, certificate)``, each class against all others; null labels are left out."""
    return {c: fit(df, features, F.col(label) == F.lit(c)) for c in classes}


def predict(df: DataFrame, fits: dict) -> DataFrame:
    """``df`` with ``prediction``: the class of the greatest margin (ties: the greater name); null features give null."""
    scored = F.array(*[F.struct(f.margin().alias("margin"), F.lit(c).alias("class")) for c, (f, _) in sorted(fits.items())])
    best = F.array_max(F.filter(scored, lambda s: s["margin"].isNotNull()))
    return df.withColumn("prediction", best["class"])
