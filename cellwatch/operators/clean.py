"""Clean hourly readings (P1, F12-F14, X8, X9) and its data-quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

NUMERIC = ["soc", "voltage", "temperature", "rents"]


def to_timestamp_column(df: DataFrame, drop_existing: bool = True) -> DataFrame:
    """``hour_bucket`` becomes ``timestamp``. By default an existing ``timestamp`` is
    dropped first; ``drop_existing=False`` only renames (the notebook variant, D3)."""
    if "hour_bucket" in df.columns:
        if drop_existing:
            df = df.drop("timestamp")
        df = df.withColumnRenamed("hour_bucket", "timestamp")
    return df


def typed(df: DataFrame) -> DataFrame:
    """timestamp and numeric columns typed; unparsable values and NaN -> null."""
    cols = {"timestamp": S.to_timestamp_ntz("timestamp")}
    for c in NUMERIC:
        if c in df.columns:
            cols[c] = S.to_double(c)
    return df.withColumns(cols)


def clean(df: DataFrame, drop_existing_timestamp: bool = True) -> DataFrame:
    """Rename, type, normalise serials, keep rows with time, SoC >= 0 and voltage > 0.

    Row order is not kept (the later windows order by time themselves).
    """
    return prepared(df, drop_existing_timestamp).filter(usable())


def prepared(df: DataFrame, drop_existing_timestamp: bool = True) -> DataFrame:
    """Renamed, typed and serial-normalised rows, before any is dropped."""
    df = typed(to_timestamp_column(df, drop_existing_timestamp))
    if "battery_serial_number" in df.columns:
        df = df.withColumn("battery_serial_number", S.clean_serial("battery_serial_number"))
    return df


def usable() -> Column:
    """Time known, SoC known and not negative, voltage known and positive."""
    return F.coalesce(F.col("timestamp").isNotNull() & (F.col("soc") >= 0) & (F.col("voltage") > 0), F.lit(False))


def clean_summary(raw: DataFrame) -> DataFrame:
    """Rows and distinct devices before and after cleaning (one row, one pass)."""
    ok = usable()
    return prepared(raw).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_distinct("bloqs_id").alias("bloqs_before"),
        F.count(F.when(ok, 1)).alias("rows_after"),
        F.count_distinct(F.when(ok, F.col("bloqs_id"))).alias("bloqs_after"))
