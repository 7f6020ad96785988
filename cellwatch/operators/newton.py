"""M6 by Newton steps: the weighted L2 logistic regression as one plain aggregate a step.

At coefficients b a step needs, over all training rows, the loss, its gradient and the Gramian
of the features weighted by w * p * (1 - p): with d features (the intercept among them) that
is 1 + d + d * (d + 1) / 2 sums, computed in one aggregation with map-side combine. The d x d
system is solved on the driver. The objective is convex and the steps are damped (halved
until the objective falls), so the end is the minimum; near it the error squares at every step,
which takes about eight passes over the rows.

The objective is the original's: ``0.5 * |b|^2 / C + sum_i w_i * logloss_i``, the intercept
without penalty.

The fitted model is a list of numbers. ``probability`` compiles it, with the imputer, the
scaler and the one-hot levels before it, into one Spark expression: no vectors and no Python,
so scoring stays inside whole-stage code generation (M7, M14).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-13        # Newton decrement, relative to the objective, at which the fit ends
MAX_STEPS = 60           # passes over the rows, halved steps included


@dataclass
class Fit:
    coefficients: np.ndarray       # the last one is the intercept
    objective: float
    passes: int
    converged: bool


def sigmoid(z: Column) -> Column:
    """1 / (1 + exp(-z)); exp overflows to infinity, which gives 0."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _dot(b: list[float], x: list[Column]) -> Column:
    out = F.lit(0.0)
    for v, c in zip(b, x):
        out = out + F.lit(float(v)) * c
    return out


def _sums(rows: DataFrame, names: list[str], b: np.ndarray):
    """Loss, gradient and Gramian of the data part at ``b``; one job.

    ``rows``: columns ``names`` (the features without the intercept), ``y`` and ``w``.
    """
    d = len(names) + 1
    z = _dot(b, [F.col(n) for n in names]) + F.lit(float(b[-1]))
    p = sigmoid(F.col("z"))
    # log(1 + exp(z)) without overflow
    loss = F.col("w") * (F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z"))
    at = rows.select(*names, "y", "w", z.alias("z")).select(
        *names, (F.col("w") * (p - F.col("y"))).alias("r"), (F.col("w") * p * (1 - p)).alias("v"), loss.alias("loss"))
    x = [*names, None]                                     # None: the constant 1

    def times(c: Column, n) -> Column:
        return c if n is None else c * F.col(n)

    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = at.agg(F.sum("loss").alias("loss"), *[F.sum(times(F.col("r"), n)) for n in x],
                 *[F.sum(times(times(F.col("v"), x[i]), x[j])) for i, j in pairs]).first()
    gradient = np.array(row[1:1 + d], float)
    gramian = np.zeros((d, d))
    for (i, j), v in zip(pairs, row[1 + d:]):
        gramian[i, j] = gramian[j, i] = v
    return float(row[0]), gradient, gramian


def minimise(rows: DataFrame, names: list[str], c_inverse: float = 1.0, tolerance: float = TOLERANCE,
             max_steps: int = MAX_STEPS) -> Fit:
    """Coefficients of ``names`` and the intercept at the objective's minimum."""
    penalty = np.r_[np.full(len(names), 1.0 / c_inverse), 0.0]
    b = np.zeros(len(names) + 1)
    before, f_before, step = None, math.inf, None
    f = math.inf
    for passes in range(1, max_steps + 1):
        loss, g, h = _sums(rows, names, b)
        f = loss + 0.5 * float(penalty @ (b * b))
        if f > f_before + 1e-12 * abs(f_before):           # too far: half the step
            step = step / 2
            b = before + step
            continue
        g, h = g + penalty * b, h + np.diag(penalty)
        before, f_before = b, f
        step = -np.linalg.lstsq(h, g, rcond=None)[0]
        b = before + step
        if float(-g @ step) <= tolerance * max(1.0, f):
            return Fit(b, f, passes, True)
    return Fit(before, f_before, max_steps, False)


class _Shared(Params):
    scaledCols = Param(Params._dummy(), "scaledCols", "scaled numeric features", typeConverter=TypeConverters.toListString)
    categoryCol = Param(Params._dummy(), "categoryCol", "imputed category", typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", typeConverter=TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight", typeConverter=TypeConverters.toString)
    cInverse = Param(Params._dummy(), "cInverse", "inverse strength of the penalty", typeConverter=TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(scaledCols=[], categoryCol="", labelCol="y", weightCol="w", cInverse=1.0)


class NewtonLogistic(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """M4-M6: one-hot levels (alphabetical, none dropped) beside the scaled features, then the fit."""

    @keyword_only
    def __init__(self, *, scaledCols=None, categoryCol=None, labelCol=None, weightCol=None, cInverse=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "NewtonLogisticModel":
        cols, cat = self.getOrDefault(self.scaledCols), self.getOrDefault(self.categoryCol)
        levels = sorted(r[0] for r in df.select(cat).distinct().collect() if r[0] is not None)   # a few firmware classes
        numbers = [F.col(c).alias(f"x{i}") for i, c in enumerate(cols)]
        hot = [(F.col(cat) == level).cast("double").alias(f"x{len(cols) + i}") for i, level in enumerate(levels)]
        rows = df.select(*numbers, *hot, F.col(self.getOrDefault(self.labelCol)).cast("double").alias("y"),
                         F.col(self.getOrDefault(self.weightCol)).cast("double").alias("w"))
        fit = minimise(rows, [f"x{i}" for i in range(len(cols) + len(levels))], self.getOrDefault(self.cInverse))
        *weights, intercept = (float(v) for v in fit.coefficients)
        return NewtonLogisticModel(scaledCols=cols, categoryCol=cat, levels=levels, coefficients=weights,
                                   intercept=intercept, passes=fit.passes, converged=fit.converged)


class NewtonLogisticModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(Params._dummy(), "levels", "category levels", typeConverter=TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "coefficients", typeConverter=TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "intercept", typeConverter=TypeConverters.toFloat)
    passes = Param(Params._dummy(), "passes", "passes of the fit", typeConverter=TypeConverters.toInt)
    converged = Param(Params._dummy(), "converged", "whether the fit ended at the minimum",
                      typeConverter=TypeConverters.toBoolean)

    def __init__(self, *, scaledCols=None, categoryCol=None, levels=None, coefficients=None, intercept=None,
                 passes=None, converged=None):
        super().__init__()
        self._setDefault(levels=[], weights=[], offset=0.0, passes=0, converged=True)
        given = {"scaledCols": scaledCols, "categoryCol": categoryCol, "levels": levels, "weights": coefficients,
                 "offset": intercept, "passes": passes, "converged": converged}
        self._set(**{k: v for k, v in given.items() if v is not None})

    @property
    def coefficients(self) -> list[float]:
        return self.getOrDefault(self.weights)

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.offset)

    @property
    def labels(self) -> list[str]:
        return self.getOrDefault(self.levels)

    def log_odds(self) -> Column:
        """Of the scaled and imputed columns."""
        cols, cat = self.getOrDefault(self.scaledCols), self.getOrDefault(self.categoryCol)
        return log_odds([F.col(c) for c in cols], F.col(cat), self.labels, self.coefficients, self.intercept)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", sigmoid(self.log_odds()))


def log_odds(numbers: list[Column], category: Column, levels: list[str], weights: list[float],
             intercept: float) -> Column:
    """Intercept, weighted numbers and the weight of the row's level (0 for an unseen one)."""
    z = _dot(weights[:len(numbers)], numbers) + F.lit(float(intercept))
    if not levels:
        return z
    of_level = F.lit(0.0)
    for level, v in zip(levels, weights[len(numbers):]):
        of_level = F.when(category == level, F.lit(float(v))).otherwise(of_level)
    return z + of_level


def probability(prep, levels: list[str], weights: list[float], intercept: float) -> Column:
    """The whole fitted pipeline as one expression of the raw feature columns.

    ``prep``: a fitted ``ImputeScaleModel`` with one category.
    """
    numbers, categories = prep.expressions()
    return sigmoid(log_odds(list(numbers.values()), next(iter(categories.values())), levels, weights, intercept))
