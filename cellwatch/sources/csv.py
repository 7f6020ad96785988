"""S3/S4 CSV readers (tolerant and strict), S7 required-column check, S8 CSV sink.

Columns are read as strings (no ``inferSchema``: one pass, no type guessing)
and typed later by the cleaning step with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import scalar as S

# The text tokens read as missing by default (pandas read_csv defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]

LONG = "__cellwatch_long__"           # whether a record has too many fields
RECORD = "__cellwatch_record__"       # text of a record whose fields do not match the header's


def _header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    """Column names from the header line (no schema inference)."""
    try:
        return spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns
    except Exception as ex:
        if "PATH_NOT_FOUND" in str(ex) or "does not exist" in str(ex):
            raise FileNotFoundError(f"no CSV at {path}") from ex
        raise


def _records(spark: SparkSession, path: str, multi_line: bool):
    """All records as strings, the header's names and a condition for too many fields.

    Spark marks a record with fewer or more fields than the schema; its text tells which:
    the commas outside quoted fields are counted.
    """
    cols = _header(spark, path, multi_line)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cols, RECORD]])
    raw = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).csv(path))
    bare = F.regexp_replace(RECORD, r'(^|,)"(?:[^"]|"")*"', "$1")
    too_long = F.coalesce(F.regexp_count(bare, F.lit(",")) + 1 > len(cols), F.lit(False))
    # Spark refuses a query that reads the record text alone (a count), so a field is read too.
    some_field = F.length(F.coalesce(F.col(cols[0]), F.lit(""))) < 0
    return raw, cols, too_long | some_field


def na_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in cols})


def read_csv_tolerant(spark: SparkSession, path: str, multi_line: bool = True, observation=None) -> DataFrame:
    """S3: rows with too many fields are skipped; short rows are kept, padded with nulls.

    Default missing-value tokens become null. All columns are strings. ``multi_line``: quoted
    fields may hold line ends, which makes a file one task; False lets Spark split files.
    ``observation`` counts the records and the skipped ones as they are read.
    """
    raw, cols, too_long = _records(spark, path, multi_line)
    raw = raw.withColumn(LONG, too_long)
    if observation is not None:
        raw = raw.observe(observation, F.count(F.lit(1)).alias("records"),
                          F.count(F.when(F.col(LONG), 1)).alias("records_skipped"))
    return na_to_null(raw.filter(~F.col(LONG)).select(*cols), cols)


def read_csv_strict(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A row with too many fields fails the read, a short one is padded with nulls; a missing
    file raises FileNotFoundError."""
    raw, cols, too_long = _records(spark, path, multi_line)
    fail = F.raise_error(F.concat(F.lit("too many fields: "), F.col(RECORD))).cast("boolean")
    return na_to_null(raw.filter(F.when(too_long, fail).otherwise(F.lit(True))).select(*cols), cols)


def require_columns(df: DataFrame, required=tuple(C.REQUIRED_HOURLY), what: str = "dataset") -> DataFrame:
    """Raise listing the missing columns (the time column may still be ``hour_bucket``)."""
    have = set(df.columns)
    if "hour_bucket" in have:
        have.add("timestamp")
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df


def write_csv(df: DataFrame, path: str, single_file: bool = False, order=None) -> str:
    """Header CSV, overwriting. Partitions are written as they are (sorted ones stay sorted);
    ``single_file`` gathers them in one ordered part, for small results."""
    out = df
    if single_file:
        out = out.repartition(1)
        if order:
            out = out.sortWithinPartitions(*order)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def report_path(base: str, as_of=None, prefix: str = "battery_risk_") -> str:
    """``<base>/battery_risk_<yyyyMMdd>`` for the given (or today's) date."""
    from datetime import datetime
    stamp = (datetime.fromisoformat(str(as_of)) if as_of else datetime.now()).strftime("%Y%m%d")
    return f"{base.rstrip('/')}/{prefix}{stamp}"


def to_iso_text(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text so a written CSV round-trips through the tolerant reader."""
    return df.withColumns({f.name: S.col(f.name).cast("string") for f in df.schema.fields
                           if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))})
