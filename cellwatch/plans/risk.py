"""M15 train and M14 score: the two user-facing model pipelines.

Train: hourly -> daily features, checkpointed (the one expensive part: extract,
sessions, rollup) -> label -> complete rows (X11) -> session split (C5),
persisted (several passes follow: statistics, indexer, LR iterations,
metrics) -> fit -> held-out metrics.

Score: hourly -> daily features -> newest day per battery (W12) -> probability
(M7) -> alert (F19) and voltage band (F18) -> ordered report (O3).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..operators import labels as LB
from ..operators import metrics as ME
from ..operators import model as MD
from . import chain


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame             # one row; ranking metrics null when the test split has one class (M11)
    train_rows: int
    test_rows: int
    positive_rate: float
    frame: DataFrame | None = None   # the persisted training frame (lazy ``metrics`` read it)
    coefficients: DataFrame | None = None   # M12, set by the train job

    def release(self) -> None:
        """Drop the persisted training frame once ``metrics`` has been read."""
        if self.frame is not None:
            self.frame.unpersist()
            self.frame = None


def materialized_daily(hourly: DataFrame, data_end=None) -> DataFrame:
    """T6 daily features written to the shared checkpoint folder (survives lost
    executors; cuts the lineage so later passes do not redo the extract)."""
    return C.materialize(chain.daily_features(hourly, data_end), "daily_features")


def training_frame(daily: DataFrame, notebook: bool = False) -> DataFrame:
    """Labelled complete rows with their split flag, persisted for the fit's passes
    (recomputed from the checkpointed daily table if a block is lost)."""
    features = C.NUM_FEATURES if notebook else C.FEATURES_ALL          # D6
    split = LB.split_sessions(LB.model_rows(daily, features))
    rows = LB.model_rows(LB.add_label(daily), features)
    return rows.join(split, C.SESSION_KEYS).persist(StorageLevel.MEMORY_AND_DISK)


def train_from_daily(daily: DataFrame, notebook: bool = False, digits: int | None = None,
                     **fit_kw) -> TrainResult:
    """``digits``: round the probabilities before they are ranked, so that rows with equal
    features tie however their sums were ordered."""
    marked = training_frame(daily, notebook)
    stats = marked.agg(F.coalesce(F.sum("is_train"), F.lit(0)).alias("tr"),
                       F.coalesce(F.sum(1 - F.col("is_train")), F.lit(0)).alias("te"),
                       F.avg(F.col("y_risk").cast("double")).alias("pr")).first()
    train_df = marked.filter("is_train = 1").drop("is_train")
    test_df = marked.filter("is_train = 0").drop("is_train")
    model = MD.fit_risk_model(train_df, **fit_kw)
    scored = MD.predict(model, test_df)
    if digits is not None:
        scored = scored.withColumn("risk_prob", F.round("risk_prob", digits))
    metrics = ME.evaluate(scored)
    return TrainResult(model, metrics, int(stats["tr"]), int(stats["te"]), float(stats["pr"] or 0.0),
                       frame=marked)


def train(hourly: DataFrame, notebook: bool = False, **fit_kw) -> TrainResult:
    """M15 from hourly readings."""
    return train_from_daily(materialized_daily(hourly), notebook, **fit_kw)


def latest_per_battery(daily: DataFrame) -> DataFrame:
    """The newest day per battery; two sessions on that day -> the later session."""
    w = Window.partitionBy(*C.BATTERY_KEYS).orderBy(F.col("date").desc(), F.col("session_id").desc())
    return daily.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def report(latest_scored: DataFrame) -> DataFrame:
    """F18, F19, P3, O3 on rows carrying ``risk_prob``."""
    out = latest_scored.withColumns({
        "model_alert": S.flag_at_least("risk_prob", C.ALERT_THRESHOLD),
        "risk_score_voltage": S.voltage_band("volt_mean"),
    })
    cols = [c for c in C.REPORT_COLUMNS if c in out.columns]
    return (out.select(*cols)
               .orderBy(F.col("model_alert").desc(), F.col("risk_prob").desc_nulls_last(),
                        *[F.col(k) for k in C.BATTERY_KEYS]))


def score(hourly: DataFrame, model: PipelineModel, notebook: bool = False, data_end=None) -> DataFrame:
    """T8 risk report, one row per battery.

    Canonical: rows with a missing feature are not scored (``risk_prob`` null,
    alert 0). ``notebook=True`` scores them through the fitted imputers (D7).
    """
    return score_from_daily(chain.daily_features(hourly, data_end), model, notebook)


def score_from_daily(daily: DataFrame, model: PipelineModel, notebook: bool = False) -> DataFrame:
    latest = latest_per_battery(daily)
    scored = MD.predict(model, latest)
    if not notebook:
        complete = F.lit(True)
        for c in C.FEATURES_ALL:
            complete = complete & F.col(c).isNotNull()
            if c in C.NUM_FEATURES:
                complete = complete & ~F.isnan(F.col(c))
        scored = scored.withColumn("risk_prob", F.when(complete, F.col("risk_prob")))
    return report(scored)


def top_risks(report_df: DataFrame, n: int = C.TOP_RISKS) -> DataFrame:
    """The first ``n`` rows of the ordered report."""
    return report_df.limit(n)
