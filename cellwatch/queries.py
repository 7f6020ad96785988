"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator group.

Each reads the driver's tables (through ``sources.tables``) so its work grows
with them. Float outputs are rounded to 6 dp, counts are BIGINT, timestamps are
TIMESTAMP_NTZ, so the DuckDB oracle can compare exact value hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from . import config as C
from .operators import clean as CL
from .operators import extract as X
from .operators import labels as LB
from .operators import sessions as SE
from .plans import chain, fleet
from .sources import tables as T

REGISTRY: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


# --- E1 / E2 -----------------------------------------------------------------
@register
def hourly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, X1, X2, X4, X12."""
    return X.hourly_latest(T.snapshots(spark, sf_dir), C.FLEET_AS_OF).select(
        "snapshot_id", "bloqs_id", "hour_bucket", "system_updated_at")


@register
def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, F3-F8, X5 on top of hourly_latest."""
    return X.hourly_readings(T.snapshots(spark, sf_dir), C.FLEET_AS_OF)


@register
def rents_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, X7, F2, A1 over the whole event table."""
    return X.rents_per_hour(T.raw_events(spark, sf_dir)).select(
        "bloq", "timestp", as_bigint("rents"))


@register
def fleet_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full extract with rents."""
    return fleet.fleet_extract(T.snapshots(spark, sf_dir), T.raw_events(spark, sf_dir),
                               C.FLEET_AS_OF)


@register
def silent_batteries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3, X6, A2, F9, X10, O1, P5."""
    return fleet.silent_batteries(T.snapshots(spark, sf_dir), C.SILENT_AS_OF)


def as_bigint(name: str):
    return F.col(name).cast("bigint").alias(name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle does the same) for exact value hashes."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, TY.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 hourly readings: the fleet extract over the whole derived tables."""
    return fleet.fleet_extract(T.snapshots(spark, sf_dir), T.raw_events(spark, sf_dir), C.FLEET_AS_OF)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract, written once as a parquet table in the shared checkpoint folder (as it hands
    over to the model steps). For steps that read their input in several branches: from the
    written table each branch is a cheap columnar scan instead of a second run of the extract."""
    return C.materialize(_extract(spark, sf_dir), "hourly")


# --- C1 / C2 -----------------------------------------------------------------
@register
def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1, F12-F14, X8, X9."""
    return rounded(CL.clean(_extract(spark, sf_dir)))


@register
def clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct devices before/after cleaning."""
    return CL.clean_summary(_extract(spark, sf_dir)).select(
        *[as_bigint(c) for c in ["rows_before", "bloqs_before", "rows_after", "bloqs_after"]])


@register
def serial_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled serial and running session id per battery row."""
    s = SE.assign_sessions(CL.clean(_hourly(spark, sf_dir)))
    return s.select("bloqs_id", "battery_name", "timestamp", "battery_serial_number", "session_id")


@register
def battery_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 (W3-W7, J4, F16, F17, P2, P3)."""
    return rounded(chain.sessions(_hourly(spark, sf_dir)))


@register
def session_censoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: sessions and censored sessions."""
    return SE.censored_sessions(chain.sessions(_hourly(spark, sf_dir)))


@register
def days_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days left per reading of finished sessions."""
    s = chain.sessions(_hourly(spark, sf_dir))
    return s.filter("is_censored = 0").select(
        "bloqs_id", "battery_name", "session_id", "timestamp", "battery_end_time", "days_left")


# --- C3 / C4 / C5 ------------------------------------------------------------
_ROLL = ["volt_slope_3d", "volt_slope_7d", "volt_vol_7d", "soc_slope_3d", "soc_slope_7d", "soc_vol_7d"]
_DAILY = C.DAILY_KEYS + ["country", "address", "point_code", "fw_version_type",
                         "soc_mean", "soc_min", "volt_mean", "temp_mean", "rents_sum"]


@register
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per battery session day."""
    from .operators import features as FE
    return rounded(FE.daily_rollup(chain.sessions(_hourly(spark, sf_dir))))


@register
def rolling_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3- and 7-row OLS slopes."""
    d = chain.daily_features(_hourly(spark, sf_dir))
    return rounded(d.select(*C.DAILY_KEYS, "volt_slope_3d", "volt_slope_7d", "soc_slope_3d", "soc_slope_7d"))


@register
def rolling_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7-row sample std, 0 under three rows."""
    d = chain.daily_features(_hourly(spark, sf_dir))
    return rounded(d.select(*C.DAILY_KEYS, "volt_vol_7d", "soc_vol_7d"))


@register
def daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6."""
    return rounded(chain.daily_features(_hourly(spark, sf_dir)).select(*_DAILY, *_ROLL))


@register
def risk_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 (K1 parity frame): future_min_soc, y_risk."""
    d = chain.labelled(_hourly(spark, sf_dir))
    return rounded(d.select(*C.DAILY_KEYS, "soc_min", "future_min_soc", "y_risk"))


@register
def risk_label_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 option: true look-ahead over the next 7 rows."""
    d = chain.labelled(_hourly(spark, sf_dir), lookahead=True)
    return rounded(d.select(*C.DAILY_KEYS, "soc_min", "future_min_soc", "y_risk"))


@register
def session_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, O5 (seeded md5 order, bucketed global rank), J3 flag.

    As in training, the split runs on the written daily table: its bucket-size
    branch and its ranking branch then re-read that table, not the windows."""
    from .plans.risk import materialized_daily
    return LB.split_sessions(LB.model_rows(materialized_daily(_hourly(spark, sf_dir))))


# --- ML statistics, report and metrics ----------------------------------------
def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete labelled rows with their session split flag, from the written daily table."""
    from .plans.risk import materialized_daily
    daily = materialized_daily(_hourly(spark, sf_dir))
    return LB.model_rows(LB.add_label(daily)).join(LB.split_sessions(LB.model_rows(daily)), C.SESSION_KEYS)


@register
def impute_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3 on the training split: median, mean, population std (scale), mode."""
    from .operators.model import stats_frame
    from .operators.preprocess import ImputeScale
    train = _marked(spark, sf_dir).filter("is_train = 1")
    prep = ImputeScale(numericCols=C.NUM_FEATURES, categoricalCols=C.CAT_FEATURES).fit(train)
    return rounded(stats_frame(prep, spark))


@register
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 balanced class weights on the training split."""
    from .operators.model import class_weights as cw
    return rounded(cw(_marked(spark, sf_dir).filter("is_train = 1")))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.risk import latest_per_battery
    return latest_per_battery(chain.daily_features(_hourly(spark, sf_dir)))


@register
def latest_per_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest day per battery (later session on a shared day)."""
    return rounded(_latest(spark, sf_dir).select(*C.DAILY_KEYS, "soc_min", "volt_mean"))


@register
def voltage_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18 over every battery day."""
    from .functions.scalar import voltage_band as vb
    d = chain.daily_features(_hourly(spark, sf_dir))
    return rounded(d.select(*C.DAILY_KEYS, "volt_mean", vb("volt_mean").alias("risk_score_voltage")))


def fixed_report_score(df: DataFrame) -> DataFrame:
    """A fixed arithmetic score in [0, 1) (exact in IEEE arithmetic, with ties) standing
    in for a model's probability, so report ordering can be checked by SQL."""
    return df.withColumn("risk_prob", (F.col("soc_min") * 7 % 100) / 100)


@register
def risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 report on a fixed score: F18, F19, P3, O3."""
    from .plans.risk import report
    return rounded(report(fixed_report_score(_latest(spark, sf_dir))))


@register
def risk_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 of the ordered report (a top-k report: the limit is the feature)."""
    from .plans.risk import report, top_risks
    return rounded(top_risks(report(fixed_report_score(_latest(spark, sf_dir)))))


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed scores with ties and a correlated 0/1 label, one per event."""
    ev = T.read_table(spark, sf_dir, "events")
    base = F.col("event_id") * 37 % 1000
    return ev.select(
        "event_id",
        (base / 1000.0).alias("risk_prob"),
        F.when(base + F.col("user_id") * 53 % 400 >= 700, 1).otherwise(0).alias("y_risk"))


@register
def alert_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alert when the probability is at least 0.8."""
    from .functions.scalar import flag_at_least
    s = event_scores(spark, sf_dir)
    return s.select("event_id", "risk_prob", flag_at_least("risk_prob", C.ALERT_THRESHOLD).alias("model_alert"))


@register
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 on fixed scores (ties count one half)."""
    from .operators.metrics import ranking_metrics
    return rounded(ranking_metrics(event_scores(spark, sf_dir)).select("roc_auc"))


@register
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 on fixed scores (step-wise over distinct scores)."""
    from .operators.metrics import ranking_metrics
    return rounded(ranking_metrics(event_scores(spark, sf_dir)).select("average_precision"))


@register
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10/A11 at the alert threshold on fixed scores."""
    from .operators.metrics import threshold_metrics as tm
    return rounded(tm(event_scores(spark, sf_dir)))


@register
def score_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact p01, p05, p50, p95, p99 of fixed scores."""
    from .operators.metrics import score_quantiles as sq
    return rounded(sq(event_scores(spark, sf_dir)))


# --- end-to-end model pipelines and sources ------------------------------------
RANKED_DIGITS = 9          # of probabilities, where their ties matter


@register
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the extract; the held-out metrics row (ranking metrics null and
    ``evaluable`` false where the test split has one class), with the size of both splits."""
    from .plans.risk import train
    res = train(_hourly(spark, sf_dir), digits=RANKED_DIGITS)
    row = res.metrics.first()                                   # one row
    res.release()
    values = (res.train_rows, res.test_rows, *row)
    kinds = TY.StructType([TY.StructField("train_rows", TY.LongType()), TY.StructField("test_rows", TY.LongType()),
                           *res.metrics.schema.fields])
    return rounded(spark.createDataFrame([values], kinds))


@register
def coef_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named coefficients of the fit, by absolute value."""
    from .operators.model import coefficients
    from .plans.risk import train
    res = train(_hourly(spark, sf_dir))
    named = coefficients(res.model, spark, top=C.TOP_COEFFICIENTS)
    res.release()
    return rounded(named)


@register
def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save and reload the model (S9), score the newest day per battery."""
    from .config import scratch_path
    from .sources.models import load_model, save_model
    from .plans.risk import materialized_daily, score_from_daily, train_from_daily
    daily = materialized_daily(_hourly(spark, sf_dir))      # one extract for both
    res = train_from_daily(daily)
    path = save_model(res.model, scratch_path(spark, "model"))
    res.release()
    return rounded(score_from_daily(daily, load_model(path)))


@register
def csv_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S8: the extract written as CSV to the shared folder, read back tolerantly and typed."""
    from .config import scratch_path
    from .sources.csv import read_csv_tolerant, to_iso_text, write_csv
    extract = _extract(spark, sf_dir)
    path = write_csv(to_iso_text(extract), scratch_path(spark, "extract.csv"))
    back = read_csv_tolerant(spark, path)
    return rounded(back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in extract.schema.fields]))


@register
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and time of dated extracts (one per data day) in a folder."""
    from .config import scratch_path
    from .sources.csv import to_iso_text
    from .sources.files import newest_input
    folder = scratch_path(spark, "input")
    hourly = to_iso_text(_extract(spark, sf_dir).withColumn(
        "_file", F.concat(F.date_format("hour_bucket", "yyyyMMdd"), F.lit("0600_battery_deploy.csv"))))
    hourly.write.mode("overwrite").option("header", True).partitionBy("_file").csv(folder)
    return newest_input(spark, folder).select("name", "stamp")


@register
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored, share at or above the alert threshold, exact percentiles."""
    from .operators.metrics import score_summary as ss
    return rounded(ss(event_scores(spark, sf_dir)))


@register
def fleet_extract_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with old event history dropped at the scan (S2, W2): the same rows."""
    return fleet.fleet_extract(T.snapshots(spark, sf_dir), T.raw_events(spark, sf_dir), C.FLEET_AS_OF,
                               prune_events=True)


def _counts(spark: SparkSession, given, names: list[str]) -> DataFrame:
    kinds = ", ".join(f"{n} {'timestamp_ntz' if n == 'data_end' else 'bigint'}" for n in names)
    return spark.createDataFrame([tuple(getattr(given, n) for n in names)], kinds)


@register
def extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pass that writes the extract counts on its way."""
    from .plans import observed
    given = observed.extract(T.snapshots(spark, sf_dir), T.raw_events(spark, sf_dir), C.FLEET_AS_OF)
    return _counts(spark, given, ["snapshots", "malformed_lists", "rows_before", "rows_after", "data_end"])


@register
def csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read and skipped (every fifth hour's have a field too many), readings
    before and after cleaning and the data end, from the one pass over a CSV."""
    from .config import scratch_path
    from .plans import observed
    from .sources.csv import read_csv_tolerant, to_iso_text
    extra = F.when(F.hour("hour_bucket") % 5 == 0, F.lit(",more")).otherwise(F.lit(""))
    rows = _extract(spark, sf_dir).withColumn("point_code", F.concat(F.coalesce("point_code", F.lit("")), extra))
    path = scratch_path(spark, "long.csv")
    to_iso_text(rows).write.option("header", True).option("quote", "\u0000").csv(path)     # commas stay bare
    given = observed.csv(read_csv_tolerant, spark, path, multi_line=False)
    return _counts(spark, given, ["records", "records_skipped", "rows_before", "rows_after", "data_end"])


@register
def labelled_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled chain on a table bucketed by battery (no exchange)."""
    from .config import scratch_path
    path = scratch_path(spark, "hourly-table")
    name = "hourly_" + path.rsplit("-", 1)[1]
    table = T.save_hourly(_extract(spark, sf_dir), name, int(spark.conf.get("spark.sql.shuffle.partitions")), path)
    return rounded(chain.labelled(table).select(*C.DAILY_KEYS, "soc_min", "future_min_soc", "y_risk"))


SPAN_PROBS = [0.05, 0.5, 0.95]


@register
def span_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 from mergeable sketches a day: quantiles of SoC, voltage and temperature by week."""
    from .operators.sketches import merged_quantiles, sketch_by
    readings = CL.clean(_extract(spark, sf_dir))
    days = C.materialize(sketch_by(readings, [F.col("timestamp").cast("date").alias("day")],
                                   ["soc", "voltage", "temperature"]), "day-sketches")
    weeks = merged_quantiles(days, [F.date_trunc("week", "day").cast("date").alias("week")], SPAN_PROBS)
    return rounded(weeks.withColumn("n", F.col("n").cast("bigint")))


@register
def csv_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S8: the extract written as CSV, read back strictly and typed."""
    from .config import scratch_path
    from .sources.csv import read_csv_strict, to_iso_text, write_csv
    extract = _extract(spark, sf_dir)
    back = read_csv_strict(spark, write_csv(to_iso_text(extract), scratch_path(spark, "strict.csv")), multi_line=False)
    return rounded(back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in extract.schema.fields]))


@register
def training_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of dated extracts (one per data day) the training file, its readings of
    each battery as fetched by name, the required columns it lacks and the dated report's name."""
    from .config import scratch_path
    from .sources.csv import report_path, require_columns, to_iso_text
    from .sources.files import training_input
    from .sources.models import fetch_dataset
    folder = scratch_path(spark, "training")
    stamp = F.date_format("hour_bucket", "yyyyMMdd")
    label = F.when(F.dayofmonth("hour_bucket") % 3 == 0, F.lit("_Train.csv")).otherwise(F.lit("_deploy.csv"))
    rows = _extract(spark, sf_dir).drop("rents").withColumn("_file", F.concat(stamp, label))
    to_iso_text(rows).write.option("header", True).partitionBy("_file").csv(folder)
    chosen = training_input(spark, folder).select("name", "path").first()              # one row
    data = fetch_dataset(spark, folder, chosen["path"].rsplit("/", 1)[1])
    try:
        require_columns(data)
        lacks = None
    except ValueError as ex:
        lacks = str(ex)
    report = report_path("out", f"{chosen['name'][:4]}-{chosen['name'][4:6]}-{chosen['name'][6:8]}")
    return data.groupBy("bloqs_id", "battery_name").agg(F.count(F.lit(1)).alias("readings")).select(
        F.lit(chosen["name"]).alias("name"), F.lit(lacks).alias("lacks"), F.lit(report).alias("report"),
        "bloqs_id", "battery_name", as_bigint("readings"))


@register
def published_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model published twice and loaded from its newest version."""
    from .config import scratch_path
    from .operators.model import coefficients
    from .plans.risk import train
    from .sources.models import load_model, publish_model
    res = train(_hourly(spark, sf_dir))
    folder = scratch_path(spark, "published")
    publish_model(res.model, folder)
    model = load_model(publish_model(res.model, folder))
    res.release()
    return rounded(coefficients(model, spark))


@register
def silent_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the silent report with each row's place in its order (ties by the battery's identity)."""
    from .operators.ranking import positions
    silent = fleet.silent_batteries(T.snapshots(spark, sf_dir), C.SILENT_AS_OF)
    keys = ["bloq_id", "battery_name", "battery_serial_number", "bloq_name", "partner", "address", "city", "country"]
    return positions(silent, [F.desc("hours_since_last_comm"), *[F.asc_nulls_first(k) for k in keys]])


@register
def report_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the report on a fixed score with each row's place in its order."""
    from .operators.ranking import positions
    from .plans.risk import report
    rows = report(fixed_report_score(_latest(spark, sf_dir)))
    order = [F.desc("model_alert"), F.desc_nulls_last("risk_prob"), F.asc("bloqs_id"), F.asc("battery_name")]
    return positions(rows, order).select("bloqs_id", "battery_name", "model_alert", as_bigint("position"))


@register
def sessions_without_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that lack the place columns and the partner: the first come back as nulls."""
    hourly = _hourly(spark, sf_dir).drop("country", "address", "point_code", "partner")
    out = chain.sessions(hourly)
    return rounded(out.select("timestamp", "bloqs_id", "battery_name", "session_id", "is_censored", "days_left",
                              "country", "address", "point_code", F.lit("partner" in out.columns).alias("has_partner")))
