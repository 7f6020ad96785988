"""A12 at scale: mergeable quantile sketches (KLL) a day, merged for any span of days.

``quantiles`` counts and range-partitions all values for every question. Here each day's values
are summarised once, in a few kilobytes, and a span's quantiles come from its days' sketches
alone. Sketches are built with map-side partial aggregation, so a hot day is many partial
sketches. Ranks are off by at most ``rank_error(k)`` of the rows (with 99 % confidence); a span
of at most ``k`` values is exact: the smallest value that p of the values do not exceed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

ACCURACY = 4096


def rank_error(k: int = ACCURACY) -> float:
    """Normalised rank error of a KLL sketch (99 % confidence)."""
    return 2.296 / k ** 0.9021


def sketch_by(df: DataFrame, keys: list[Column | str], cols: list[str], k: int = ACCURACY) -> DataFrame:
    """keys, feature, n and sketch of the known values of each column (nulls and NaN left out)."""
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), S.nan_to_null(F.col(c).cast("double")).alias("value")) for c in cols])).alias("e"))
    names = long.columns[:-1]
    return (long.select(*names, "e.feature", "e.value").filter("value IS NOT NULL").groupBy(*names, "feature")
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch")))


def merged_quantiles(sketches: DataFrame, keys: list[Column | str], probs: list[float]) -> DataFrame:
    """keys, feature, prob, n and value: quantiles of the groups of sketches that share ``keys``."""
    d = sketches.select(*keys, "feature", "n", "sketch")
    names = d.columns[:-3]
    merged = d.groupBy(*names, "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    values = F.arrays_zip(wanted.alias("prob"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return merged.select(*names, "feature", "n", F.explode(values).alias("q")).select(
        *names, "feature", "n", F.col("q.prob").alias("prob"), F.col("q.value").alias("value"))
