"""Fixed values, feature lists and session helpers shared by every module."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# These must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------
HORIZON = 7                 # label look-back/ahead rows
SOC_THRESHOLD = 60          # future min SoC below this -> at risk
ALERT_THRESHOLD = 0.8       # probability at or above this -> alert
RANDOM_STATE = 42           # seed of the session split
TRAIN_SHARE = 0.8           # share of sessions used for training
CENSOR_TOLERANCE = "1 hour"  # session end this close to the data end -> censored
VOLTAGE_WARNING = 12.7      # below -> "Warning"
VOLTAGE_EARLY_WARNING = 12.9  # [12.7, 12.9] -> "Early Warning", else "OK"
INVALID_SERIALS = ["", "N/A", "nan", "None"]
RECENT_FIRMWARE_PREFIX = "7.1."
OLD_FIRMWARE_EXCLUDED = ["7.1.1", "7.1.2"]
FIRMWARE_CLASSES = ("recent", "old")
VOLTAGE_BANDS = ("Warning", "Early Warning", "OK")
FLEET_POWER_SOURCE = "BATTERY"       # devices kept by the fleet filter
EXCLUDED_LIFECYCLE = "terminated"
ACTIVE_FLAG = "true"                 # text, not boolean
BATTERY_TAGS = ["bat1", "bat2"]      # both must occur in the lower-cased firmware text
PARTNER_SUFFIX_LEN = 5      # partner = device name without its last 5 chars
FLEET_LOOKBACK_MONTHS = 1   # fleet extract span
SILENT_LOOKBACK_DAYS = 30   # silent report span
SILENT_HOURS = 24           # silent when no update for this many hours
SCORE_QUANTILES = [0.01, 0.05, 0.50, 0.95, 0.99]
TOP_RISKS = 10
TOP_COEFFICIENTS = 30

# Column names and their order, as the original's tables have them.
NUM_FEATURES = [
    "volt_mean", "volt_slope_3d", "volt_slope_7d", "volt_vol_7d",
    "soc_slope_3d", "soc_slope_7d", "soc_vol_7d",
    "temp_mean", "rents_sum",
]
CAT_FEATURES = ["fw_version_type"]
FEATURES_ALL = NUM_FEATURES + CAT_FEATURES

BATTERY_KEYS = ["bloqs_id", "battery_name"]
SESSION_KEYS = BATTERY_KEYS + ["session_id"]
DAILY_KEYS = SESSION_KEYS + ["date"]

REQUIRED_HOURLY = ["timestamp", "bloqs_id", "battery_name", "soc", "voltage",
                   "temperature", "rents"]
SESSION_COLUMNS = [
    "timestamp", "partner", "bloq_name", "fw_version_type", "bloqs_id",
    "battery_name", "battery_serial_number", "soc", "voltage", "temperature",
    "rents", "days_left", "battery_start_time", "battery_end_time",
    "session_id", "is_censored", "country", "address", "point_code",
]
REPORT_COLUMNS = [
    "date", "bloqs_id", "battery_name", "country", "fw_version_type",
    "soc_mean", "volt_mean", "temp_mean", "rents_sum",
    "risk_score_voltage", "risk_prob", "model_alert", "address", "point_code",
]

# Anchors of the fixture built from the driver's `events` table (January 2024).
FLEET_AS_OF = "2024-02-10 00:00:00"
SILENT_AS_OF = "2024-01-31 00:00:00"


def build_session(master: str | None = None, app: str = "cellwatch",
                  shuffle_partitions: int | None = None, **extra) -> SparkSession:
    """Session with the settings the library relies on (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage and written intermediates.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as is; where it is unset this raises. Only a local master, whose
    executors are the driver's own threads, gets a fresh local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:          # a Spark Connect session has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    master = sc.master if sc else "remote"
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: master {master} needs a folder all executors share")
    path = tempfile.mkdtemp(prefix="cellwatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    if sc:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir().rstrip("/")
    return path


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint (survives lost executors), in one
    job, and later passes read it columnar with pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _intermediates.append(path)
    return spark.read.schema(df.schema).parquet(path)


_intermediates: list[str] = []     # paths written by materialize() in this process


def drop_intermediates(spark: SparkSession) -> int:
    """Delete the tables written by :func:`materialize` so far; frames that read them are void.

    For the end of a job. Returns the number of tables."""
    n = len(_intermediates)
    while _intermediates:
        path = spark._jvm.org.apache.hadoop.fs.Path(_intermediates.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
