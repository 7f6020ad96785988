"""Daily rollup per battery session (A3-A6) and rolling row-window features.

Windows count **rows** (days with data), not calendar days (K7). The slope is
the least-squares slope of the values against their position, computed by the
built-in ``regr_slope`` over a ROWS frame — no Python per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S

DAILY_TEXT = ["country", "address", "point_code", "fw_version_type"]


def first_non_null(c: str, order: str = "timestamp") -> Column:
    """A4: first non-null value in time order (order-independent after a shuffle)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))


def daily_rollup(df: DataFrame) -> DataFrame:
    """One row per (bloqs_id, battery_name, session_id, date).

    Rows with a null key are dropped (group-by semantics of the original).
    """
    cols = {
        "timestamp": S.to_timestamp_ntz("timestamp"),
        "session_id": F.coalesce(F.col("session_id").try_cast("int"), F.lit(0)),
        "fw_version_type": F.col("fw_version_type").cast("string"),
    }
    for c in ["soc", "voltage", "temperature", "rents"]:
        cols[c] = S.to_double(c)
    for c in ["country", "address", "point_code"]:
        if c not in df.columns:
            cols[c] = F.lit(None).cast("string")
    d = df.withColumns(cols).filter(F.col("timestamp").isNotNull())
    d = d.withColumn("date", F.to_date("timestamp"))
    d = d.filter(F.col("bloqs_id").isNotNull() & F.col("battery_name").isNotNull())
    return d.groupBy(*C.DAILY_KEYS).agg(
        *[first_non_null(c).alias(c) for c in DAILY_TEXT],
        F.avg("soc").alias("soc_mean"),
        F.min("soc").alias("soc_min"),
        F.avg("voltage").alias("volt_mean"),
        F.avg("temperature").alias("temp_mean"),
        F.coalesce(F.sum("rents"), F.lit(0.0)).alias("rents_sum"),
    )


def _session_window():
    return Window.partitionBy(*C.SESSION_KEYS).orderBy("date")


def rolling_slope(y: str, rows: int, min_rows: int) -> Column:
    """OLS slope of ``y`` over the last ``rows`` rows, null under ``min_rows``."""
    frame = _session_window().rowsBetween(-(rows - 1), Window.currentRow)
    n = F.count(F.col(y)).over(frame)
    return F.when(n >= min_rows, F.regr_slope(F.col(y), F.col("_pos")).over(frame))


def rolling_std(y: str, rows: int, min_rows: int) -> Column:
    """Sample std over the last ``rows`` rows; 0 under ``min_rows``."""
    frame = _session_window().rowsBetween(-(rows - 1), Window.currentRow)
    n = F.count(F.col(y)).over(frame)
    return F.coalesce(F.when(n >= min_rows, F.stddev_samp(F.col(y)).over(frame)), F.lit(0.0))


def add_rolling(daily: DataFrame) -> DataFrame:
    """W8-W10 for voltage and SoC means."""
    d = daily.withColumn("_pos", F.row_number().over(_session_window()).cast("double"))
    return d.withColumns({
        "volt_slope_3d": rolling_slope("volt_mean", 3, 2),
        "volt_slope_7d": rolling_slope("volt_mean", 7, 3),
        "volt_vol_7d": rolling_std("volt_mean", 7, 3),
        "soc_slope_3d": rolling_slope("soc_mean", 3, 2),
        "soc_slope_7d": rolling_slope("soc_mean", 7, 3),
        "soc_vol_7d": rolling_std("soc_mean", 7, 3),
    }).drop("_pos")


def build_features(df_sessions: DataFrame) -> DataFrame:
    """T6 daily features."""
    return add_rolling(daily_rollup(df_sessions))
