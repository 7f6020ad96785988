"""Running sums in a global order, without an ordered window over all rows in one task.

Rows are range-partitioned once and written with the number of their partition. The totals of
the partitions (a row each) become offsets, and the running sums inside a partition are added to
them. One path for every size: partitions grow in number with ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C


def running_sums(df: DataFrame, order: list[str | Column], sums: list[str], name: str) -> DataFrame:
    """``df`` with ``<c>_before`` (sum of ``c`` over all earlier rows) and ``<c>_total`` for each
    ``c`` of ``sums``. ``order`` must tell all rows apart (rows are grouped by it beforehand)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = C.materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    offsets = totals.select(                       # a row for each partition
        F.col("_part").alias("_p"),
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_offset") for c in sums],
        *[F.sum(f"_{c}").over(everything).alias(f"{c}_total") for c in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
    for c in sums:
        out = out.withColumn(f"{c}_before", F.col(f"_{c}_offset") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.select(*df.columns, *[f"{c}_{x}" for c in sums for x in ("before", "total")])


def positions(df: DataFrame, order: list[str | Column], column: str = "position") -> DataFrame:
    """O1, O3: ``df`` with each row's place (from 1) in a global order that tells all rows apart."""
    one = "_one"
    t = running_sums(df.withColumn(one, F.lit(1).cast("bigint")), order, [one], "positions")
    return t.select(*df.columns, (F.col(f"{one}_before") + 1).alias(column))
