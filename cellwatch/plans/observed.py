"""Counts that come with the pass that writes a hand-over table: no second scan.

``DataFrame.observe`` gathers aggregates while rows stream through a plan. The extract is
written once (T3) and tells how many snapshots it used, how many battery lists were malformed
(F4), how many readings cleaning keeps (A9) and when the data ends (J4). A CSV hand-over is
written typed and tells how many records were skipped (S3). The session step then takes
the data end as a value and reads its input once.

The counts of the last stage are exact. Those gathered before a shuffle count a task again if it is
run again after a lost executor; a job that needs them exact then uses ``clean_summary``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as CL
from . import fleet


@dataclass
class HandOver:
    table: DataFrame                  # readings, written and read back
    rows_before: int                  # readings before cleaning
    rows_after: int
    data_end: datetime | None         # newest time that cleaning keeps (J4)
    snapshots: int | None = None      # device-hours the extract exploded
    malformed_lists: int | None = None
    records: int | None = None        # CSV records read
    records_skipped: int | None = None


def _written(readings: DataFrame, name: str) -> tuple[DataFrame, dict]:
    seen = Observation()
    ok = CL.usable()
    rows = readings.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.count(F.when(ok, 1)).alias("rows_after"),
                            F.max(F.when(ok, F.col("timestamp"))).alias("data_end"))
    return C.materialize(rows, name), seen.get


def extract(snapshots: DataFrame, events: DataFrame, as_of=None) -> HandOver:
    """E1 written as typed readings, with its counts."""
    lists = Observation()
    hourly = fleet.fleet_extract(snapshots, events, as_of, observation=lists)
    table, seen = _written(CL.prepared(hourly), "hourly")
    return HandOver(table, **seen, **lists.get)


def csv(read, *args, **kw) -> HandOver:
    """A CSV read by ``read(..., observation=...)`` (``sources.csv``), written as typed readings."""
    records = Observation()
    table, seen = _written(CL.prepared(read(*args, observation=records, **kw)), "readings")
    return HandOver(table, **seen, **records.get)


def readings(hourly: DataFrame) -> HandOver:
    """Any hourly readings, written typed."""
    table, seen = _written(CL.prepared(hourly), "readings")
    return HandOver(table, **seen)

