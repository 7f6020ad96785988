"""Fleet extract building blocks: raw snapshots/events -> hourly battery readings.

Every step is ``DataFrame -> DataFrame`` and declarative, so Catalyst keeps
filters below the rankings, prunes the columns, and turns each
``row_number() = 1`` into a partial + final ``WindowGroupLimit`` (map-side
top-1, so one hot device-hour never reaches a single task in full).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from .prune import maybe_recent

def as_of_ts(as_of) -> Column:
    """The reference time (``current_timestamp`` by default) as TIMESTAMP_NTZ."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def fleet_filter(df: DataFrame) -> DataFrame:
    """Battery-powered, live (status known and not terminated), active devices."""
    return df.filter(
        (F.col("powersource") == C.FLEET_POWER_SOURCE)
        & F.col("lifecyclestatus").isNotNull()
        & (F.col("lifecyclestatus") != C.EXCLUDED_LIFECYCLE)
        & (F.col("active") == C.ACTIVE_FLAG))


def since_months(df: DataFrame, as_of=None, months: int = C.FLEET_LOOKBACK_MONTHS) -> DataFrame:
    """``system_updated_at >= current_date - INTERVAL 'n' MONTH``."""
    start = F.add_months(F.to_date(as_of_ts(as_of)), -months).cast("timestamp_ntz")
    return df.filter(F.col("system_updated_at") >= start)


def since_days(df: DataFrame, as_of=None, days: int = C.SILENT_LOOKBACK_DAYS) -> DataFrame:
    """``system_updated_at >= current_date - INTERVAL 'n' DAY``."""
    start = F.date_sub(F.to_date(as_of_ts(as_of)), days).cast("timestamp_ntz")
    return df.filter(F.col("system_updated_at") >= start)


def latest_per_hour(df: DataFrame, tie_breakers=("snapshot_id",)) -> DataFrame:
    """W1 + X12: newest snapshot per device per hour.

    Ties on ``system_updated_at`` are broken by the given columns (descending)
    when present, so the result does not depend on partitioning.
    """
    df = df.withColumn("hour_bucket", S.hour_floor("system_updated_at"))
    order = [F.col("system_updated_at").desc()] + [
        F.col(c).desc() for c in tie_breakers if c in df.columns]
    w = Window.partitionBy("bloqs_id", "hour_bucket").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def both_batteries(df: DataFrame) -> DataFrame:
    """The firmware document mentions BAT1 and BAT2 (text test, after ranking)."""
    fw = F.lower(F.col("firmwaredetails"))
    cond = F.lit(True)
    for tag in C.BATTERY_TAGS:
        cond = cond & fw.contains(tag)
    return df.filter(cond)


# Paths into the JSON documents of the snapshot text columns (they must equal the
# source system's). The battery list is JSON text inside the firmware document.
NAME, APM, CODE = "$.bloqitName", "$.apm_name", "$.vintedCode"                 # metadata
COUNTRY, ADDRESS, CITY = "$.country", "$.address", "$.city"                    # details
FIRMWARE, BATTERIES = "$.firmwareVersion", "$.battery"                         # firmwaredetails
BATTERY_NAME, CHARGE, VOLTAGE, TEMPERATURE, SERIAL = (                         # an element of the list
    "$.batteryName", "$.capacityStateOffCharge", "$.voltage", "$.temperature", "$.extraInfo.battery_serial_number")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def json_scalar(doc: Column, path: str) -> Column:
    """the text of a JSON scalar of a VARIANT; null for an object, an array or an absent path."""
    kind = _kind(F.try_variant_get(doc, path, "variant"))
    return F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), F.try_variant_get(doc, path, "string"))


def parse_documents(df: DataFrame) -> DataFrame:
    """each JSON text column parsed once, into a VARIANT (null where it isn't JSON)."""
    return (df
            .withColumn("_meta", F.try_parse_json("metadata"))
            .withColumn("_det", F.try_parse_json("details"))
            .withColumn("_fw", F.try_parse_json("firmwaredetails")))


def battery_list(doc: Column, strict: bool = False) -> Column:
    """the battery array of a firmware document: JSON text in a string (K6), or, unless
    ``strict``, a real array. Null where there is none or the text is no JSON array."""
    inside = F.try_variant_get(F.try_parse_json(json_scalar(doc, BATTERIES)), "$", "array<variant>")
    if strict:
        return inside
    real = F.try_variant_get(doc, BATTERIES, "variant")
    return F.when(_kind(real).startswith("ARRAY"), F.try_variant_get(real, "$", "array<variant>")).otherwise(inside)


def malformed_list(doc: Column) -> Column:
    """whether a battery list is given that is no JSON array (the original's query fails there)."""
    return F.coalesce(F.try_variant_get(doc, BATTERIES, "variant").isNotNull() & battery_list(doc).isNull(), F.lit(False))


def explode_batteries(df: DataFrame, strict: bool = False, observation=None) -> DataFrame:
    """J2 + F4: one row per element of the embedded battery array (null/empty -> none).
    ``observation`` counts the rows and, of them, the malformed lists."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("snapshots"),
                        F.count(F.when(malformed_list(F.col("_fw")), 1)).alias("malformed_lists"))
    return df.withColumn("_bat", F.explode(battery_list(F.col("_fw"), strict)))


def battery_readings(pf: DataFrame, strict: bool = False, observation=None) -> DataFrame:
    """Projection of query step 2 (F5-F8, F11) and its filter X5. ``strict``: K6, a battery list
    counts only where it is text."""
    meta, det, fw, bat = (F.col(c) for c in ("_meta", "_det", "_fw", "_bat"))
    out = (explode_batteries(parse_documents(pf), strict, observation)
           .withColumns({"_name": json_scalar(meta, NAME), "_version": json_scalar(fw, FIRMWARE),
                         "battery_name": json_scalar(bat, BATTERY_NAME), "_soc": json_scalar(bat, CHARGE)})
           .filter((F.col("battery_name") != "") & (F.col("_soc") != "")))
    return out.select(
        "hour_bucket", "bloqs_id",
        S.partner_from_name("_name").alias("partner"),
        F.col("_name").alias("bloq_name"),
        F.col("_version").alias("fw_version"),
        S.firmware_class("_version").alias("fw_version_type"),
        "battery_name",
        S.to_double("_soc").alias("soc"),
        json_scalar(bat, VOLTAGE).alias("voltage"),
        json_scalar(bat, TEMPERATURE).alias("temperature"),
        json_scalar(bat, SERIAL).alias("battery_serial_number"),
        json_scalar(det, COUNTRY).alias("country"),
        json_scalar(det, ADDRESS).alias("address"),
        F.coalesce(json_scalar(meta, APM), json_scalar(meta, CODE)).alias("point_code"),
    )


def hourly_latest(snaps: DataFrame, as_of=None) -> DataFrame:
    """Steps 0-1 of the fleet extract: filtered, newest per device-hour, both batteries."""
    return both_batteries(latest_per_hour(since_months(fleet_filter(snaps), as_of)))


def hourly_readings(snaps: DataFrame, as_of=None, observation=None) -> DataFrame:
    """Steps 0-2: one row per battery per device-hour (no rents yet)."""
    return battery_readings(hourly_latest(snaps, as_of), observation=observation)


def latest_event_versions(events: DataFrame, tie_breakers=("ingest_seq",)) -> DataFrame:
    """W2 + X7: events with a device, newest ingested version per ``events_id``."""
    ev = with_device(events)
    order = [F.col("pipeline_ingested_at").desc()] + [
        F.col(c).desc() for c in tie_breakers if c in ev.columns]
    w = Window.partitionBy("events_id").orderBy(*order)
    return (ev.withColumn("timestp", S.iso_hour("timestamp"))
              .withColumn("_rn", F.row_number().over(w))
              .filter("_rn = 1")
              .select("rent", "bloq", "timestp"))


def with_device(events: DataFrame) -> DataFrame:
    """Events that name a device."""
    return events.filter(F.col("bloq").isNotNull())


def rents_per_hour(events: DataFrame, since: Column | None = None, prune: bool = False) -> DataFrame:
    """A1: distinct rents per device per hour (two-phase, distinct-expanded).

    ``since`` may drop hours no reading can match; it is applied after the
    version ranking, never before (versions of one event may move in time).
    ``prune``: events none of whose versions lies in those hours leave at the scan
    (``prune.maybe_recent``), before the ranking's shuffle; the result is the same.
    """
    if prune and since is not None:
        events = maybe_recent(with_device(events), "events_id", S.iso_hour("timestamp") >= since)
    ev = latest_event_versions(events)
    if since is not None:
        ev = ev.filter(F.col("timestp") >= since)
    return (ev.groupBy("bloq", "timestp")
              .agg(F.count_distinct("rent").alias("rents")))


def attach_rents(readings: DataFrame, rents: DataFrame) -> DataFrame:
    """J1 + P4: ``readings LEFT JOIN rents ON bloq = bloqs_id AND timestp = hour_bucket``."""
    r = rents.select(F.col("bloq").alias("_rb"), F.col("timestp").alias("_rt"), "rents")
    joined = readings.join(
        r, (readings["bloqs_id"] == r["_rb"]) & (readings["hour_bucket"] == r["_rt"]), "left")
    return joined.select(*[readings[c] for c in readings.columns], r["rents"])


def silent_candidates(snaps: DataFrame, as_of=None) -> DataFrame:
    """Steps 0-2 of the silent report: battery rows of the last 30 days (X6 only)."""
    pf = both_batteries(latest_per_hour(since_days(fleet_filter(snaps), as_of)))
    meta, det, bat = (F.col(c) for c in ("_meta", "_det", "_bat"))
    out = (explode_batteries(parse_documents(pf))
           .withColumns({"_name": json_scalar(meta, NAME), "battery_name": json_scalar(bat, BATTERY_NAME)})
           .filter(F.col("battery_name") != ""))
    return out.select(
        "bloqs_id", "hour_bucket",
        "battery_name",
        json_scalar(bat, SERIAL).alias("battery_serial_number"),
        F.col("_name").alias("bloq_name"),
        json_scalar(det, ADDRESS).alias("address"),
        json_scalar(det, CITY).alias("city"),
        json_scalar(det, COUNTRY).alias("country"),
        S.partner_from_name("_name").alias("partner"),
    )


def last_seen(batteries: DataFrame, as_of=None) -> DataFrame:
    """A2 + F9: newest hour per battery identity and whole hours since then."""
    keys = ["bloqs_id", "battery_name", "battery_serial_number", "bloq_name",
            "partner", "address", "city", "country"]
    agg = batteries.groupBy(*keys).agg(F.max("hour_bucket").alias("last_update"))
    return agg.withColumn(
        "hours_since_last_comm",
        F.timestamp_diff("HOUR", F.col("last_update"), as_of_ts(as_of)).cast("bigint"))
