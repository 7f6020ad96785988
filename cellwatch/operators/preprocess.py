"""M1-M3: median imputation + standardisation of numerics, most-frequent category.

A small Spark ML ``Estimator``/``Model`` pair, persistable inside a
``PipelineModel``. Fitting runs two distributed aggregations (moments, counts
and modes in one, plus the exact median by selection);
transforming is plain column expressions, so it stays in whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

SCALED_SUFFIX = "__scaled"
IMPUTED_SUFFIX = "__imputed"


class _ImputeScaleParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns",
                        typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical input columns",
                            typeConverter=TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[])

    def scaled_cols(self) -> list[str]:
        return [c + SCALED_SUFFIX for c in self.getOrDefault(self.numericCols)]

    def imputed_cols(self) -> list[str]:
        return [c + IMPUTED_SUFFIX for c in self.getOrDefault(self.categoricalCols)]


class ImputeScale(Estimator, _ImputeScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits medians, means, population stds and category modes on a training frame."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ImputeScaleModel":
        """One pass for counts and moments (beside the quantiles' counts), one for the
        medians, one for each mode. Mean and std are those of the median-imputed
        column, combined from the observed values' moments and the imputed count."""
        num = self.getOrDefault(self.numericCols)
        cat = self.getOrDefault(self.categoricalCols)
        extra = [F.count(F.lit(1)).alias("__rows")]
        for i, c in enumerate(num):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            extra += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        qs = exact_quantiles(df, num, [0.5], extra=extra) if num else {
            "__extra__": df.agg(*extra).first()}
        row = qs["__extra__"]
        medians, means, scales = [], [], []
        for i, c in enumerate(num):
            med = qs[c][0]
            n_obs, rows = row[f"n{i}"], row["__rows"]
            mean, var = row[f"m{i}"], row[f"v{i}"]
            k = rows - n_obs if med is not None else 0          # imputed rows
            if n_obs and k:
                tot = n_obs + k
                delta = med - mean
                mean_all = mean + delta * k / tot
                var = (var * n_obs + delta * delta * n_obs * k / tot) / tot
                mean = mean_all
            medians.append(_num(med))
            means.append(_num(mean))
            scales.append(_scale(None if var is None else math.sqrt(max(var, 0.0))))
        # Modes: counts per level, then the largest (ties: the smallest level), a row each.
        modes = []
        for c in cat:
            top = (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("k"))
                   .orderBy(F.desc("k"), c).limit(1).collect())
            modes.append(top[0][c] if top else None)
        return ImputeScaleModel(
            numericCols=num, categoricalCols=cat, medians=medians, means=means, scales=scales,
            modes=["" if m is None else str(m) for m in modes])


def _num(v) -> float:
    return float("nan") if v is None else float(v)


def _scale(std) -> float:
    """Zero or undefined spread -> scale 1 (the column passes through centred)."""
    if std is None or std != std or abs(std) < 1e-12:
        return 1.0
    return float(std)


class ImputeScaleModel(Model, _ImputeScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "median per numeric column",
                    typeConverter=TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean per numeric column (after imputation)",
                  typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population std per numeric column",
                   typeConverter=TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "most frequent value per categorical column",
                  typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, medians=None, means=None,
                 scales=None, modes=None):
        super().__init__()
        self._setDefault(medians=[], means=[], scales=[], modes=[])
        self._set(**self._input_kwargs)

    def stats(self) -> list[tuple]:
        num = self.getOrDefault(self.numericCols)
        return list(zip(num, self.getOrDefault(self.medians), self.getOrDefault(self.means),
                        self.getOrDefault(self.scales)))

    def expressions(self) -> tuple[dict[str, Column], dict[str, Column]]:
        """Scaled numeric and imputed categorical columns, by input name."""
        numbers, categories = {}, {}
        for c, med, mean, scale in self.stats():
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            if med == med:   # not NaN
                x = F.coalesce(x, F.lit(med))
            numbers[c] = (x - F.lit(mean)) / F.lit(scale)
        for c, mode in zip(self.getOrDefault(self.categoricalCols), self.getOrDefault(self.modes)):
            categories[c] = F.coalesce(F.col(c).cast("string"), F.lit(mode))
        return numbers, categories

    def _transform(self, df: DataFrame) -> DataFrame:
        numbers, categories = self.expressions()
        return df.withColumns({c + SCALED_SUFFIX: x for c, x in numbers.items()}
                              | {c + IMPUTED_SUFFIX: x for c, x in categories.items()})
