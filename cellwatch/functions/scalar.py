"""Column expressions (all JVM-side built-ins, no Python UDFs).

Each helper takes and returns ``Column`` objects so it can be used in
``select``/``withColumn``/``filter`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts) -> Column:
    """the hour of a TIMESTAMP_NTZ, by subtracting what is past it: on the wall clock alone,
    so no session zone (nor an hour that a zone skips) can move it."""
    t = col(ts).cast("timestamp_ntz")
    past = F.make_dt_interval(mins=F.minute(t), secs=F.date_part(F.lit("SECOND"), t))
    return t - past


def iso_hour(text) -> Column:
    """ISO-8601 text -> hour bucket on the written wall clock.

    The zone suffix is dropped rather than applied, as the cast from a zoned
    timestamp to a plain one does. Unparsable text gives null.
    """
    return hour_floor(col(text).try_cast("timestamp_ntz"))


def nan_to_null(c) -> Column:
    """NaN -> null, so ``> 0`` and ``>= 0.8`` cannot be true for NaN."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def to_double(c) -> Column:
    """Text or number -> double; junk and NaN -> null."""
    return nan_to_null(col(c).try_cast("double"))


def to_timestamp_ntz(c) -> Column:
    """text or timestamp -> TIMESTAMP_NTZ; unparsable -> null."""
    return col(c).try_cast("timestamp_ntz")


def partner_from_name(name) -> Column:
    """device name minus its last five characters when longer than five."""
    n = col(name)
    return (F.when(n.isNull(), F.lit(None).cast("string"))
            .when(F.length(n) > C.PARTNER_SUFFIX_LEN,
                  n.substr(F.lit(1), F.length(n) - C.PARTNER_SUFFIX_LEN))
            .otherwise(n))


def firmware_class(version) -> Column:
    """'recent' for 7.1.x except 7.1.1 and 7.1.2; everything else 'old'."""
    v = col(version)
    recent = v.startswith(C.RECENT_FIRMWARE_PREFIX) & ~v.isin(*C.OLD_FIRMWARE_EXCLUDED)
    new, old = C.FIRMWARE_CLASSES
    return F.when(F.coalesce(recent, F.lit(False)), new).otherwise(old)


def clean_serial(serial) -> Column:
    """serial stripped of surrounding whitespace; '', 'N/A', 'nan', 'None' -> null."""
    t = F.regexp_replace(col(serial).cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(~t.isin(*C.INVALID_SERIALS), t)


def round_half_even(x, digits: int = 1) -> Column:
    """K2: round half to even, as pandas does."""
    return F.bround(col(x), digits)


def days_between(end, start) -> Column:
    """F16: (end - start) in days as a double, rounded half-even to 0.1."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return round_half_even(micros / F.lit(86_400_000_000.0), 1)


def voltage_band(volt) -> Column:
    """<12.7 Warning; 12.7..12.9 (both ends) Early Warning; else (and null) OK."""
    v = col(volt)
    warning, early, ok = C.VOLTAGE_BANDS
    return (F.when(v < C.VOLTAGE_WARNING, warning)
            .when(v.between(C.VOLTAGE_WARNING, C.VOLTAGE_EARLY_WARNING), early)
            .otherwise(ok))


def flag_at_least(x, threshold: float) -> Column:
    """1 when x >= threshold, else 0 (null and NaN -> 0)."""
    return F.coalesce((nan_to_null(x) >= threshold).cast("int"), F.lit(0))


def flag_below(x, threshold: float) -> Column:
    """1 when x < threshold, else 0 (null and NaN -> 0)."""
    return F.coalesce((nan_to_null(x) < threshold).cast("int"), F.lit(0))


def filename_datetime(name) -> Column:
    """leading 12-digit (yyyyMMddHHmm) else 8-digit (yyyyMMdd) stamp."""
    n = col(name)
    d12 = F.regexp_extract(n, r"^(\d{12})", 1)
    d8 = F.regexp_extract(n, r"^(\d{8})", 1)
    return F.coalesce(
        F.when(d12 != "", F.try_to_timestamp(d12, F.lit("yyyyMMddHHmm"))),
        F.when(d8 != "", F.try_to_timestamp(d8, F.lit("yyyyMMdd"))),
    ).cast("timestamp_ntz")


def date_stamp(ts) -> Column:
    """yyyyMMdd text of a date/timestamp."""
    return F.date_format(col(ts), "yyyyMMdd")
