"""Linear and logistic models from aggregates of the rows.

Least squares, ridge, lasso and elastic net need nothing but the means and the covariances of features and target, so all of
them, with any penalties, are one pass; what is left are a few numbers per pair of features. A logistic model is fitted
by Newton steps, each one aggregate: the sums of the slope and of the curvature.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    n: int
    means: list[float]
    target_mean: float
    covariances: list[list[float]]
    with_target: list[float]


@dataclass(frozen=True)
class Linear:
    intercept: float
    weights: list[float]

    def prediction(self, features: Sequence[str]) -> Column:
        return sum((F.lit(w) * F.col(f) for w, f in zip(self.weights, features)), F.lit(self.intercept))


def moments(rows: DataFrame, features: Sequence[str], target: str) -> Moments | None:
    """One pass; rows with a null in any of the columns don't count. None where none is left."""
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    present = rows.dropna(subset=[*features, target])
    found = present.agg(
        F.count(F.lit(1)),
        F.avg(target),
        *[F.avg(f) for f in features],
        *[F.covar_pop(f, target) for f in features],
        *[F.covar_pop(features[i], features[j]) for i, j in pairs],
    ).first()
    if not found[0]:
        return None
    table = [[0.0] * k for _ in range(k)]
    for (i, j), value in zip(pairs, found[2 + 2 * k :]):
        table[i][j] = table[j][i] = value
    return Moments(found[0], list(found[2 : 2 + k]), found[1], table, list(found[2 + k : 2 + 2 * k]))


def fit(m: Moments, l1: float = 0.0, l2: float = 0.0, tolerance: float = 1e-13, rounds: int = 200_000) -> Linear:
    """Minimises half the mean squared error + l1 |w| + l2 |w|^2 / 2; the intercept is free.

    Without an l1 penalty the normal equations are solved. With one, coordinates descend in turn, each to its own
    minimum, until none moves by more than ``tolerance`` of the largest.
    """
    import numpy as np

    c, y = np.array(m.covariances), np.array(m.with_target)
    if not l1:
        w = np.linalg.lstsq(c + l2 * np.eye(len(y)), y, rcond=None)[0]
    else:
        w = np.zeros(len(y))
        for _ in range(rounds):
            before = w.copy()
            for j in range(len(y)):
                if c[j, j] + l2 > 0:
                    rest = y[j] - c[j] @ w + c[j, j] * w[j]
                    w[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (c[j, j] + l2)
            if np.abs(w - before).max(initial=0.0) <= tolerance * max(np.abs(w).max(initial=0.0), 1e-300):
                break
    return Linear(float(m.target_mean - w @ np.array(m.means)), [float(x) for x in w])


def lasso(m: Moments, alpha: float = 1.0) -> Linear:
    return fit(m, l1=alpha)


def elastic_net(m: Moments, alpha: float = 1.0, l1_share: float = 0.5) -> Linear:
    return fit(m, l1=alpha * l1_share, l2=alpha * (1 - l1_share))


def ridge(m: Moments, alpha: float = 1.0) -> Linear:
    """Minimises the sum of squared errors + alpha |w|^2."""
    return fit(m, l2=alpha / m.n)


def optimality_gap(m: Moments, model: Linear, l1: float = 0.0, l2: float = 0.0) -> float:
    """How far the model is from satisfying the conditions of a minimum, as a share of the l1 penalty or of the largest covariance."""
    import numpy as np

    c, y, w = np.array(m.covariances), np.array(m.with_target), np.array(model.weights)
    slope = y - c @ w - l2 * w
    off = np.where(w != 0, np.abs(slope - l1 * np.sign(w)), np.maximum(np.abs(slope) - l1, 0.0))
    return float(off.max(initial=0.0) / (l1 or max(np.abs(y).max(initial=0.0), 1e-300)))


@dataclass(frozen=True)
class Logistic:
    """Weights of the standardised features; ``centres`` and ``scales`` say how these are made."""

    intercept: float
    weights: list[float]
    centres: list[float]
    scales: list[float]

    def score(self, features: Sequence[str]) -> Column:
        """The probability of the class 1."""
        terms = [F.lit(w) * _standard(f, c, s) for w, f, c, s in zip(self.weights, features, self.centres, self.scales)]
        return 1 / (1 + F.exp(-sum(terms, F.lit(self.intercept))))


def _standard(feature: str, centre: float, scale: float) -> Column:
    return (F.col(feature) - F.lit(centre)) / F.lit(scale)


def slopes(rows: DataFrame, features: Sequence[str], label: str, model: Logistic, l2: float) -> list[float]:
    """The slope of mean log loss + l2 |w|^2 / 2 along the intercept and each weight; all vanish at the minimum."""
    off = model.score(features) - F.col(label).cast("double")
    along = [F.lit(1.0), *[_standard(f, c, s) for f, c, s in zip(features, model.centres, model.scales)]]
    found = rows.agg(*[F.avg(off * x) for x in along]).first()
    return [g + l2 * w for g, w in zip(found, [0.0, *model.weights])]


def fit_logistic(rows: DataFrame, features: Sequence[str], label: str, l2: float = 0.01, steps: int = 30, tolerance: float = 1e-12) -> Logistic:
    """Minimises mean log loss + l2 |w|^2 / 2 over standardised features, the intercept free; ``rows`` are read once per step.

    A step that does not bring the slope down is halved. A feature without spread has no weight. Labels are 0 and 1.
    """
    import numpy as np

    k = len(features)
    start = rows.agg(F.count(F.lit(1)), *[F.avg(f) for f in features], *[F.stddev_pop(f) for f in features]).first()
    centres = [float(x or 0.0) for x in start[1 : 1 + k]]
    scales = [float(x) if x else 1.0 for x in start[1 + k :]]
    w = np.zeros(k + 1)
    if not start[0]:
        return Logistic(0.0, [0.0] * k, centres, scales)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    along = [F.lit(1.0), *[_standard(f, c, s) for f, c, s in zip(features, centres, scales)]]
    penalty = np.array([0.0, *[l2] * k])
    best, step = np.inf, np.zeros(k + 1)
    for _ in range(steps):
        model = Logistic(float(w[0]), [float(x) for x in w[1:]], centres, scales)
        p = model.score(features)
        found = rows.select(p.alias("_p"), F.col(label).cast("double").alias("_y"), *[x.alias(f"_x{i}") for i, x in enumerate(along)]).agg(
            *[F.avg((F.col("_p") - F.col("_y")) * F.col(f"_x{i}")) for i in range(k + 1)],
            *[F.avg(F.col("_p") * (1 - F.col("_p")) * F.col(f"_x{i}") * F.col(f"_x{j}")) for i, j in pairs],
        ).first()
        slope = np.array(found[: k + 1]) + penalty * w
        size = float(np.abs(slope).max())
        if size >= best and np.abs(step).max() > tolerance:
            step = step / 2
            w = w - step
            continue
        best = size
        if size <= tolerance:
            break
        curve = np.diag(penalty + 1e-12)
        for (i, j), value in zip(pairs, found[k + 1 :]):
            curve[i, j] += value
            if i != j:
                curve[j, i] += value
        step = -np.linalg.solve(curve, slope)
        w = w + step
    return Logistic(float(w[0]), [float(x) for x in w[1:]], centres, scales)
