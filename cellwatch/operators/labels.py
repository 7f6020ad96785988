"""C4 risk label (W11, F20) and C5 seeded session split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S


def add_label(daily: DataFrame, horizon: int = C.HORIZON, threshold: float = C.SOC_THRESHOLD,
              lookahead: bool = False) -> DataFrame:
    """C4: ``future_min_soc`` and ``y_risk`` per session day.

    Default (parity, K1): the next day's minimum SoC, then the minimum of that
    over the last ``horizon`` rows -- i.e. rows t-5..t+1, not the next 7 days.
    ``lookahead=True`` is the true look-ahead over rows t+1..t+horizon.
    A day with no value in its frame gets a null minimum and label 0.
    """
    w = Window.partitionBy(*C.SESSION_KEYS).orderBy("date")
    if lookahead:
        fut = F.min("soc_min").over(w.rowsBetween(1, horizon))
        out = daily.withColumn("future_min_soc", fut)
    else:
        out = (daily.withColumn("_next_min", F.lead("soc_min").over(w))
                    .withColumn("future_min_soc",
                                F.min("_next_min").over(w.rowsBetween(-(horizon - 1), Window.currentRow)))
                    .drop("_next_min"))
    return out.withColumn("y_risk", S.flag_below("future_min_soc", threshold))


def model_rows(daily: DataFrame, features=None) -> DataFrame:
    """X11: rows with every feature present (Spark's dropna also drops NaN).

    The label, where there is one, is never null (F20), so the rows to split need no label."""
    return daily.dropna(subset=list(features or C.FEATURES_ALL))


def session_hash(seed: int = C.RANDOM_STATE):
    """Seeded order of sessions: md5 of 'seed|bloqs_id|battery_name|session_id'."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("bloqs_id"), F.col("battery_name"),
                             F.col("session_id").cast("string")))


def split_sessions(df: DataFrame, share: float = C.TRAIN_SHARE, seed: int = C.RANDOM_STATE,
                   hex_digits: int = 3) -> DataFrame:
    """One row per session with ``is_train`` (1 for the first ``floor(share*n)`` in hash order).

    The global rank is built without gathering sessions into one task: the
    first ``hex_digits`` of the hash name a bucket (16**3 = 4096 buckets, a
    fixed bound); bucket sizes are summed into offsets on that small table and
    broadcast back, and ranks inside each bucket come from a window
    partitioned by bucket. md5 spreads distinct sessions evenly over buckets.
    """
    sessions = df.select(*C.SESSION_KEYS).distinct()
    h = sessions.withColumn("_h", session_hash(seed)).withColumn("_b", F.substring("_h", 1, hex_digits))
    sizes = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # <= 16**hex_digits rows: the unpartitioned windows below run on that bound only.
    everything = Window.partitionBy()
    offsets = sizes.select(
        "_b",
        (F.sum("_cnt").over(everything.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_cnt")).alias("_before"),
        F.sum("_cnt").over(everything).alias("_n"))
    in_bucket = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *C.SESSION_KEYS))
    ranked = (h.join(F.broadcast(offsets), "_b")
               .withColumn("_rank", F.col("_before") + in_bucket))
    cut = F.floor(F.col("_n") * F.lit(share))
    return ranked.select(*C.SESSION_KEYS, (F.col("_rank") <= cut).cast("int").alias("is_train"))


def mark_split(df: DataFrame, share: float = C.TRAIN_SHARE, seed: int = C.RANDOM_STATE) -> DataFrame:
    """Rows with their session's ``is_train`` flag (one join serves both sides)."""
    return df.join(split_sessions(df, share, seed), C.SESSION_KEYS, "inner")


def session_split(df: DataFrame, share: float = C.TRAIN_SHARE, seed: int = C.RANDOM_STATE):
    """(train, test) row sets; sessions never straddle the two."""
    marked = mark_split(df, share, seed)
    return (marked.filter("is_train = 1").drop("is_train"),
            marked.filter("is_train = 0").drop("is_train"))
