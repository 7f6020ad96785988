"""The risk classifier as a Spark ML ``Pipeline``.

Stages: ``ImputeScale`` (M1-M3) -> ``NewtonLogistic`` (M4: one slot for each alphabetical
level, an unseen one all zeros; M5, M6). The objective is ``0.5*||b||^2 + C * sum_i w_i *
logloss_i`` with C = 1 and balanced weights ``w = n / (2 * n_class)`` (they sum to n).

``solver="lbfgs"`` fits the same objective with Spark's own stages: ``StringIndexer`` +
``OneHotEncoder`` -> ``VectorAssembler`` -> ``LogisticRegression``. Spark minimises ``sum_i w_i *
logloss_i / sum_i w_i + regParam/2 * ||b||^2``, which has the same minimiser when ``regParam =
1 / (C * n)``; ``standardization`` is off because the features are already standardised.

Models of either solver are applied as one expression (``risk_probability``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .newton import NewtonLogistic, NewtonLogisticModel, probability
from .preprocess import IMPUTED_SUFFIX, ImputeScale, ImputeScaleModel

WEIGHT = "_class_weight"


def class_weights(df: DataFrame, label: str = "y_risk") -> DataFrame:
    """M6 weights per class: ``n / (n_classes * n_class)`` (lazy, one row per class)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    n = per.agg(F.sum("n_class")).scalar()              # rows
    k = per.agg(F.count(F.lit(1))).scalar()             # classes present
    return per.select(F.col(label).cast("int").alias(label),
                      F.col("n_class").cast("bigint").alias("n_class"),
                      (n / (k * F.col("n_class"))).alias("weight"))


def build_pipeline(n_train: int, max_iter: int = 2000, tol: float = 1e-10,
                   label: str = "y_risk", C_inv_reg: float = 1.0, solver: str = "newton") -> Pipeline:
    cat = C.CAT_FEATURES[0]
    prep = ImputeScale(numericCols=C.NUM_FEATURES, categoricalCols=C.CAT_FEATURES)
    if solver == "newton":
        return Pipeline(stages=[prep, NewtonLogistic(
            scaledCols=prep.scaled_cols(), categoryCol=cat + IMPUTED_SUFFIX, labelCol=label, weightCol=WEIGHT,
            cInverse=C_inv_reg)])
    if solver != "lbfgs":
        raise ValueError(f"unknown solver {solver!r}; newton or lbfgs")
    indexer = StringIndexer(inputCol=cat + IMPUTED_SUFFIX, outputCol=cat + "__idx",
                            stringOrderType="alphabetAsc", handleInvalid="keep")
    # The indexer's extra "unknown" level is the last one; dropLast removes it,
    # so known levels get one slot each and an unseen level is all zeros.
    onehot = OneHotEncoder(inputCol=cat + "__idx", outputCol=cat + "__onehot", dropLast=True)
    assembler = VectorAssembler(inputCols=prep.scaled_cols() + [cat + "__onehot"],
                                outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol=WEIGHT,
                            regParam=1.0 / (C_inv_reg * max(n_train, 1)), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol,
                            family="binomial")
    return Pipeline(stages=[prep, indexer, onehot, assembler, lr])


def fit_risk_model(train: DataFrame, label: str = "y_risk", **kw) -> PipelineModel:
    """Fit on ``train`` (expected persisted or checkpointed: several passes read it)."""
    counts = {r[label]: r["n"] for r in                                  # <= 2 rows
              train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        raise ValueError(f"training data needs both classes, got {sorted(counts)}")
    n = sum(counts.values())
    w = {k: n / (len(counts) * v) for k, v in counts.items()}
    weighted = train.withColumn(
        WEIGHT, F.when(F.col(label) == 1, F.lit(w[1])).otherwise(F.lit(w[0])))
    return build_pipeline(n, label=label, **kw).fit(weighted)


def fitted_numbers(model: PipelineModel) -> tuple[list[str], list[float], float]:
    """Category levels, coefficients and intercept of a model of either solver."""
    last = model.stages[-1]
    if isinstance(last, NewtonLogisticModel):
        return last.labels, last.coefficients, last.intercept
    index = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel")
    return list(index.labels), last.coefficients.toArray().tolist(), float(last.intercept)


def risk_probability(model: PipelineModel) -> Column:
    """M7 as one expression of the raw features: imputer, scaler, one-hot levels and sigmoid."""
    prep = next(s for s in model.stages if isinstance(s, ImputeScaleModel))
    return probability(prep, *fitted_numbers(model))


def predict(model: PipelineModel, df: DataFrame, out: str = "risk_prob") -> DataFrame:
    """M7: ``df`` with the positive-class probability."""
    return df.select("*", risk_probability(model).alias(out))


def feature_names(model: PipelineModel) -> list[str]:
    prep = next(s for s in model.stages if isinstance(s, ImputeScaleModel))
    num = [f"num__{c}" for c in prep.getOrDefault(prep.numericCols)]
    cat = C.CAT_FEATURES[0]
    return num + [f"cat__{cat}_{lvl}" for lvl in fitted_numbers(model)[0]]


def coefficients(model: PipelineModel, spark: SparkSession | None = None,
                 top: int = C.TOP_COEFFICIENTS) -> DataFrame:
    """Coefficients by absolute value, named, top ``top`` (model metadata, tiny)."""
    _, coef, _ = fitted_numbers(model)
    names = feature_names(model)
    spark = spark or SparkSession.getActiveSession()
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, coef)]
    df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return df.orderBy(F.col("abs_coefficient").desc(), F.col("feature")).limit(top)


def preprocessing_stats(model: PipelineModel, spark: SparkSession | None = None) -> DataFrame:
    """M1-M3 fitted statistics of a fitted pipeline."""
    return stats_frame(next(s for s in model.stages if isinstance(s, ImputeScaleModel)), spark)


def stats_frame(prep: ImputeScaleModel, spark: SparkSession | None = None) -> DataFrame:
    """Median, mean, scale per numeric feature; mode per category (model metadata, tiny)."""
    spark = spark or SparkSession.getActiveSession()
    rows = [(c, med, mean, sc, None) for c, med, mean, sc in prep.stats()]
    rows += [(c, None, None, None, m) for c, m in zip(prep.getOrDefault(prep.categoricalCols),
                                                       prep.getOrDefault(prep.modes))]
    return spark.createDataFrame(
        rows, "feature string, median double, mean double, scale double, mode string")
