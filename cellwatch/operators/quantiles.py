"""Exact, linearly interpolated quantiles without gathering a column in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer; for a global
statistic that buffer lands in one task. Here the values of all columns are counted, the counts
are summed in value order (``ranking.running_sums``), and only the rows that hold a wanted rank
come back: two for each column and probability. A hot value is one counted row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_sums


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    extra: list | None = None) -> dict[str, list]:
    """``{col: [q(p) for p in probs]}``; nulls (and NaN) ignored; None for an empty column.

    Same definition as numpy's default, Spark's ``percentile`` and DuckDB's
    ``quantile_cont``: position ``p*(n-1)``, linear between neighbours.
    ``extra`` aggregate columns are computed beside the counts; their row is returned under
    the key ``"__extra__"``.
    """
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    counts = df.agg(*[F.count(clean[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                    *(extra or [F.lit(None).alias("__none__")])).first()
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), clean[c].alias("v"))
                                           for i, c in enumerate(cols)])).alias("e")).select("e.c", "e.v")
    counted = values.filter("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("k"))
    ranked = running_sums(counted, ["c", "v"], ["k"], "quantiles")
    first, wanted, start = [], [], 0              # first rank of each column, ranks asked for
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        first.append(start)
        for p in probs if n else ():
            r = math.floor(p * (n - 1))
            wanted += [start + r, start + min(r + 1, n - 1)]
        start += n
    hit = F.exists(F.array(*[F.lit(w).cast("bigint") for w in sorted(set(wanted))] or [F.lit(-1).cast("bigint")]),
                   lambda r: (r >= F.col("k_before")) & (r < F.col("k_before") + F.col("k")))
    rows = ranked.filter(hit).select("v", "k", "k_before").collect()      # a row for each wanted rank at most

    def nth(rank: int) -> float:
        return next(r["v"] for r in rows if r["k_before"] <= rank < r["k_before"] + r["k"])

    out: dict[str, list] = {"__extra__": counts}
    for i, c in enumerate(cols):
        n, out[c] = counts[f"n{i}"], []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            r = math.floor(p * (n - 1))
            lo, hi, part = nth(first[i] + r), nth(first[i] + min(r + 1, n - 1)), p * (n - 1) - r
            out[c].append(lo + (hi - lo) * part if part else lo)
    return out


def exact_median(df: DataFrame, cols: list[str], **kw) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5], **kw).items() if c != "__extra__"}
