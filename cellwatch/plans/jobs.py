"""E3/E4 as jobs over files or tables: the two user entry points (score, train) and the mode switch.

score_job: newest input CSV (S5) -> tolerant read (S3) -> saved model (S9) ->
    risk report (M14) -> dated CSV (S8, F23), with summary, coefficients and top risks.
train_job: training CSV (S6) -> tolerant or strict read (S3/S4, D2) -> train (M15)
    -> save (S9) and optionally publish to a shared folder (S10), with metrics and coefficients.

``source`` is a folder of CSV files, one CSV, or a Parquet folder or catalog table, which
Spark reads in many tasks (a CSV whose fields may hold line ends is one).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import metrics as ME
from ..operators import model as MD
from ..sources import csv as CSV
from ..sources import files as FS
from ..sources import models as MS
from ..sources import tables
from . import observed, risk


@dataclass
class ScoreResult:
    path: str                  # of the written report
    summary: DataFrame         # M13: rows scored, percentiles, flagged share
    coefficients: DataFrame    # M12
    top: DataFrame             # O4
    counts: observed.HandOver  # A9, S3, J4: what the one pass over the input saw


def _read(spark: SparkSession, source: str, choose, strict: bool = False, observation=None,
          multi_line: bool = False) -> DataFrame:
    """Hourly readings of a job's source; ``choose`` picks a file of a folder."""
    name = source.rstrip("/").lower()
    if name.endswith(".parquet") or "/" not in name and not name.endswith(".csv"):
        return tables.load(spark, source)
    path = source if name.endswith(".csv") else choose(spark, source)
    if strict:                                             # D2
        return CSV.read_csv_strict(spark, path, multi_line)
    return CSV.read_csv_tolerant(spark, path, multi_line, observation)


def _hand_over(spark: SparkSession, source: str, choose, strict: bool = False, multi_line: bool = False,
               required: str | None = None) -> observed.HandOver:
    """The source's readings, typed and written once, with what that pass saw. ``required``: name
    the data in the error when columns are missing (D10)."""
    def read(observation=None):
        rows = _read(spark, source, choose, strict, observation, multi_line)
        return CSV.require_columns(rows, what=required) if required else rows
    is_table = source.rstrip("/").lower().endswith(".parquet") or "/" not in source and not source.lower().endswith(".csv")
    return observed.readings(read()) if is_table or strict else observed.csv(read)


def score_job(spark: SparkSession, source: str, model_path: str, output_folder: str,
              as_of=None, notebook: bool = False, single_file: bool = False,
              multi_line: bool = False) -> ScoreResult:
    """Score the newest hourly extract in ``source``; the report goes to
    ``<output_folder>/battery_risk_<yyyyMMdd>``."""
    model = MS.load_model(model_path)
    given = _hand_over(spark, source, FS.newest_input_path, multi_line=multi_line,
                       required="the data to score" if notebook else None)
    report = risk.score(given.table, model, notebook=notebook, data_end=given.data_end)
    out = CSV.report_path(output_folder, as_of)
    order = [F.col("model_alert").desc(), F.col("risk_prob").desc_nulls_last(),
             F.col("bloqs_id"), F.col("battery_name")]
    CSV.write_csv(report, out, single_file=single_file, order=order)
    types = {f.name: f.dataType for f in report.schema.fields}
    written = spark.read.schema(report.schema).option("header", True).csv(out).select(
        *[F.col(c).cast(t).alias(c) for c, t in types.items()])
    return ScoreResult(out, ME.score_summary(written), MD.coefficients(model, spark),
                       written.orderBy(*order).limit(C.TOP_RISKS), given)


def train_job(spark: SparkSession, source: str, model_path: str,
              publish_folder: str | None = None, strict: bool = False,
              notebook: bool = False, multi_line: bool = False) -> risk.TrainResult:
    """Train on the training CSV in ``source`` (last by name among names containing
    'train'); save the model, optionally publish it."""
    given = _hand_over(spark, source, FS.training_input_path, strict, multi_line,
                       "the training data" if notebook else None)
    result = risk.train_from_daily(risk.materialized_daily(given.table, given.data_end), notebook=notebook)
    MS.save_model(result.model, model_path)
    if publish_folder:
        MS.publish_model(result.model, publish_folder)
    result.metrics = spark.createDataFrame([result.metrics.first()], result.metrics.schema)  # one row
    result.coefficients = MD.coefficients(result.model, spark)
    result.release()
    return result


def run(spark: SparkSession, mode: str, **kw):
    """The notebook's mode switch."""
    jobs = {"train": train_job, "score": score_job}
    if mode not in jobs:
        raise ValueError(f"unknown mode {mode!r}; one of {sorted(jobs)}")
    return jobs[mode](spark, **kw)


__all__ = ["score_job", "train_job", "run"]
