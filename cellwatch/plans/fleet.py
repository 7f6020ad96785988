"""E1 fleet extract and E2 silent-battery report as lazy DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import extract as X


def fleet_extract(snapshots: DataFrame, events: DataFrame, as_of=None, prune_events: bool = False,
                  observation=None) -> DataFrame:
    """One row per battery per device-hour of the last month, with its rents.

    Shuffles: (bloqs_id, hour_bucket) for the snapshot ranking; events_id for the
    event ranking; (bloq, hour, rent) then (bloq, hour) for the distinct count.
    The join reuses both hash partitionings on (device, hour), so it adds no
    exchange of its own (AQE may still turn it into a broadcast when the
    measured rents side is small). ``prune_events`` drops old event history at the scan, at the
    price of a second, narrow scan: for event tables much longer than the look-back.
    ``observation`` counts snapshots and malformed battery lists on the way.
    """
    readings = X.hourly_readings(snapshots, as_of, observation)
    # Rents older than the first reading hour can never match the left join.
    since = F.add_months(F.to_date(X.as_of_ts(as_of)), -C.FLEET_LOOKBACK_MONTHS).cast("timestamp_ntz")
    rents = X.rents_per_hour(events, since=since, prune=prune_events)
    return X.attach_rents(readings, rents)


def silent_batteries(snapshots: DataFrame, as_of=None, min_hours: int = C.SILENT_HOURS) -> DataFrame:
    """Batteries whose newest hourly snapshot is ``min_hours`` or more old."""
    seen = X.last_seen(X.silent_candidates(snapshots, as_of), as_of)
    return (seen.filter(F.col("hours_since_last_comm") >= min_hours)
                .select(F.col("bloqs_id").alias("bloq_id"), "bloq_name", "partner",
                        "battery_name", "battery_serial_number", "last_update",
                        "hours_since_last_comm", "address", "city", "country")
                .orderBy(F.col("hours_since_last_comm").desc()))
