"""Table sources: the driver's parquet tables and the two raw device tables.

The analytics run on two raw tables:

* **snapshots** (T1): one row per device state version, with three JSON text
  columns (``metadata``, ``details``, ``firmwaredetails``) and a battery list
  that is itself JSON text inside ``firmwaredetails``.
* **raw events** (T2): rent events with ISO-8601 text timestamps and several
  versions per ``events_id``.

In production both are warehouse tables (``spark.table(name)``). For tests and
benchmarks they are derived, row for row, from the driver's ``events`` table by
a fixed rule (see FIXTURES.md §2), so every query's work grows with ``events``.
The rule uses only integer and string arithmetic, so DuckDB rebuilds identical
text for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


# Known schemas skip the footer-reading job of schema inference.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (column pruning and filters reach the scan)."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, source) -> DataFrame:
    """S1/S2 in production: a DataFrame as is, a catalog table name (``db.table``,
    e.g. an Iceberg table when the catalog has it) or a parquet path."""
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def save_hourly(hourly: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Hourly readings as a catalog table laid out for the chain: by day, and bucketed on the
    battery, so that every window and the daily rollup run without an exchange. ``path``: where the
    files go, else the warehouse. Rows are dealt to their buckets before the write: a file for
    each day and bucket. ``buckets`` as many as the chain's tasks shall be.
    """
    time = "hour_bucket" if "hour_bucket" in hourly.columns else "timestamp"
    rows = hourly.withColumn("day", F.col(time).cast("date")).repartition(buckets, *C.BATTERY_KEYS)
    writer = (rows.write.mode("overwrite").format("parquet").partitionBy("day")
              .bucketBy(buckets, *C.BATTERY_KEYS).sortBy(*C.BATTERY_KEYS, time))
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return load(hourly.sparkSession, name)


def _obj(pairs, escaped: bool = False) -> str:
    """SQL text building a JSON object by concatenation (stays in generated code, unlike
    ``to_json`` of a struct). Values are SQL string expressions whose results hold no
    quotes or backslashes, or ``("raw", expr)`` for already-built object text.
    ``escaped`` writes each quote as a backslash-quote pair, for an object embedded in a
    JSON string (the SQL literal doubles the backslash)."""
    q = '\\\\"' if escaped else '"'
    parts = ["'{'"]
    for i, (key, value) in enumerate(pairs):
        parts.append("'" + ("," if i else "") + f"{q}{key}{q}:'")
        if isinstance(value, tuple):
            parts.append(value[1])
        else:
            parts += [f"'{q}'", value, f"'{q}'"]
    parts.append("'}'")
    return "concat(" + ", ".join(parts) + ")"


def _str(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


# The derivation rule of FIXTURES.md §2, as SQL expressions over `events`
# (one projection call instead of hundreds of column-building calls).
_U, _E = "user_id", "event_id"
_K = "from_json(props, 'k INT').k"
_BLOQ = f"concat('bloq-', lpad({_str(_U)}, 6, '0'))"
_SERIAL1 = (f"CASE WHEN {_E} % 5 = 0 THEN 'N/A' "
            f"WHEN {_U} % 6 = 1 THEN concat('SN-', {_str(_U)}, CASE WHEN floor({_K} / 10) % 2 = 0 THEN '-a' ELSE '-b' END) "
            f"WHEN ts < TIMESTAMP_NTZ '2024-01-16 00:00:00' THEN concat('SN-', {_str(_U)}, '-a') "
            f"ELSE concat('SN-', {_str(_U)}, '-b') END")
_BAT1 = _obj([
    ("batteryName", "'BAT1'"),
    ("capacityStateOffCharge", f"CASE WHEN {_E} % 53 = 7 THEN '-1' WHEN {_E} % 59 = 3 THEN 'n.a.' "
     f"WHEN {_E} % 61 = 5 THEN 'NaN' "
     f"ELSE concat({_str(f'floor({_K} / 3) + 58')}, '.', {_str(f'{_K} % 10')}) END"),
    ("voltage", f"CASE WHEN {_E} % 47 = 11 THEN '0' ELSE concat('12.', {_str(f'{_E} % 60 + 40')}) END"),
    ("temperature", _str(f"{_E} % 35")),
    ("extraInfo", ("raw", _obj([("battery_serial_number", _SERIAL1)], escaped=True)))], escaped=True)
_BAT2 = _obj([
    ("batteryName", f"CASE WHEN {_E} % 67 = 9 THEN '' ELSE 'BAT2' END"),
    ("capacityStateOffCharge", f"CASE WHEN {_K} % 25 = 0 THEN '' ELSE {_str(f'{_K} % 40 + 60')} END"),
    ("voltage", f"concat('13.', {_str(f'{_E} % 60 + 10')})"),
    ("temperature", _str(f"{_E} % 30")),
    ("extraInfo", ("raw", _obj([("battery_serial_number",
                                 f"CASE WHEN {_E} % 67 = 9 THEN 'was-bat2' ELSE concat('SX-', {_str(_U)}) END")],
                               escaped=True)))], escaped=True)
_BATTERIES = f"concat('[', {_BAT1}, CASE WHEN {_U} % 17 <> 16 THEN concat(',', {_BAT2}) ELSE '' END, ']')"
# A list that is cut off (its text still names both batteries), else the list; or no list at all.
_LISTED = f"CASE WHEN {_E} % 73 = 17 THEN '[bat1, bat2' ELSE {_BATTERIES} END"
_AT = (f"CASE WHEN {_E} % 29 = 0 THEN ts - INTERVAL 40 DAYS WHEN {_E} % 3 = 0 "
       "THEN ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts)) ELSE ts END")
_FW = (f"CASE {_U} % 4 WHEN 0 THEN '7.1.1' WHEN 1 THEN '7.1.5' WHEN 2 THEN '7.2.0' "
       f"ELSE '7.1.10' END")

SNAPSHOT_EXPRS = [
    f"{_E} AS snapshot_id",
    f"{_BLOQ} AS bloqs_id",
    f"concat('P', {_str(f'{_U} % 7')}) AS partner",
    f"CASE WHEN {_E} % 41 = 0 THEN 'false' ELSE 'true' END AS active",
    f"concat('LOC-', {_str(f'{_U} % 5')}) AS location",
    f"CASE WHEN {_U} % 13 = 12 THEN 'MAINS' ELSE 'BATTERY' END AS powersource",
    f"CASE WHEN event_type <> 'signup' THEN 'live' WHEN {_E} % 2 = 1 THEN 'terminated' END AS lifecyclestatus",
    "CASE {u} % 3 WHEN 0 THEN {a} WHEN 1 THEN {b} ELSE '{{}}' END AS metadata".format(
        u=_U,
        a=_obj([("bloqitName", f"concat('Partner', {_str(f'{_U} % 7')}, ' 0001')"),
                ("apm_name", f"concat('APM-', {_str(_U)})")]),
        b=_obj([("bloqitName", f"concat('LK', {_str(f'{_U} % 7')})"),
                ("vintedCode", f"concat('V-', {_str(_U)})")])),
    _obj([("country", f"CASE WHEN {_E} % 19 = 0 THEN 'FR' WHEN {_U} % 2 = 0 THEN 'PT' ELSE 'ES' END"),
          ("address", ("raw", f"CASE WHEN {_E} % 83 = 5 THEN '{{\"street\":\"Street\"}}' "
                              f"ELSE concat('\"Street ', {_str(_U)}, '\"') END")),
          ("city", f"concat('City ', {_str(f'{_U} % 5')})")]) + " AS details",
    f"CASE WHEN {_E} % 71 = 13 THEN " + _obj([("firmwareVersion", _FW)]) + " ELSE "
    + _obj([("firmwareVersion", _FW), ("battery", _LISTED)]) + " END AS firmwaredetails",
    f"{_AT} AS system_updated_at",
]

RAW_EVENT_EXPRS = [
    f"concat('ev-', {_str(f'floor({_E} / 2)')}) AS events_id",
    f"CASE WHEN {_E} % 9 <> 0 THEN concat('rent-', {_str(f'{_E} % 50')}) END AS rent",
    f"CASE WHEN {_E} % 11 <> 0 THEN {_BLOQ} END AS bloq",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), "
    f"CASE WHEN {_E} % 4 = 1 THEN '+02:00' WHEN {_E} % 43 = 2 THEN ' (bad)' ELSE 'Z' END) AS timestamp",
    "ts AS pipeline_ingested_at",
    f"{_E} AS ingest_seq",
]


def snapshots_from_events(events: DataFrame) -> DataFrame:
    """T1 raw device snapshots derived from ``events`` (one snapshot per event)."""
    return events.selectExpr(*SNAPSHOT_EXPRS)


def raw_events_from_events(events: DataFrame) -> DataFrame:
    """T2 raw rent events derived from ``events``; pairs of rows share an ``events_id``."""
    return events.selectExpr(*RAW_EVENT_EXPRS)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots_from_events(read_table(spark, sf_dir, "events"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_from_events(read_table(spark, sf_dir, "events"))
