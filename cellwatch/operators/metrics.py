"""Ranking and threshold metrics of scored rows, as distributed aggregations.

ROC AUC and average precision need, for every distinct score, the counts of positives and
negatives above and below it: running sums over the table of distinct scores
(``ranking.running_sums``). That table is written once, so the scores are computed once; a hot
score is one of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from .quantiles import exact_quantiles
from .ranking import running_sums


def _labelled_scores(df: DataFrame, score: str, label: str) -> DataFrame:
    s = S.nan_to_null(F.col(score).cast("double"))
    return (df.select(s.alias("score"), F.col(label).cast("int").alias("label"))
              .filter(F.col("score").isNotNull() & F.col("label").isNotNull()))


def score_table(df: DataFrame, score: str = "risk_prob", label: str = "y_risk") -> DataFrame:
    """Per distinct score: pos, neg, and counts strictly below (pos_lt, neg_lt) and at or
    above it (pos_ge, neg_ge), plus totals P and N on every row."""
    per = (_labelled_scores(df, score, label).groupBy("score")
           .agg(F.sum("label").cast("bigint").alias("pos"),
                F.sum(1 - F.col("label")).cast("bigint").alias("neg")))
    return ranked_scores(per)


def ranked_scores(per: DataFrame) -> DataFrame:
    """:func:`score_table` of a table of distinct scores (score, pos, neg)."""
    t = running_sums(per, ["score"], ["pos", "neg"], "scores")
    return t.select("score", "pos", "neg", F.col("pos_before").alias("pos_lt"), F.col("neg_before").alias("neg_lt"),
                    (F.col("pos_total") - F.col("pos_before")).alias("pos_ge"),
                    (F.col("neg_total") - F.col("neg_before")).alias("neg_ge"),
                    F.col("pos_total").alias("P"), F.col("neg_total").alias("N"))


def _rank_sums() -> list:
    """Sums behind ROC AUC and average precision, in doubles: products of counts pass 2**63."""
    pos = F.col("pos").cast("double")
    return [F.sum(pos * (2 * F.col("neg_lt") + F.col("neg"))).alias("_auc2"),
            F.sum(pos * F.col("pos_ge") / (F.col("pos_ge") + F.col("neg_ge"))).alias("_ap")]


def _auc():
    return F.col("_auc2") / (2.0 * F.col("P").cast("double") * F.col("N").cast("double"))


def ranking_metrics(df: DataFrame, score: str = "risk_prob", label: str = "y_risk") -> DataFrame:
    """M8 ROC AUC (ties count one half) and M9 average precision (step-wise, over distinct
    scores in decreasing order); null when only one class is present."""
    return ranking_of(score_table(df, score, label))


def ranking_of(t: DataFrame) -> DataFrame:
    """M8 and M9 of a :func:`score_table`."""
    agg = t.agg(*_rank_sums(), F.max("P").alias("P"), F.max("N").alias("N"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(F.when(ok, _auc()).alias("roc_auc"),
                      F.when(ok, F.col("_ap") / F.col("P")).alias("average_precision"))


def threshold_metrics(df: DataFrame, score: str = "risk_prob", label: str = "y_risk",
                      threshold: float = C.ALERT_THRESHOLD) -> DataFrame:
    """M10 + A11: confusion counts at the alert threshold and the derived rates."""
    s = _labelled_scores(df, score, label)
    yhat = (F.col("score") >= threshold).cast("int")
    y = F.col("label")
    c = s.agg(F.count(F.lit(1)).alias("rows"),
              F.sum(yhat * y).alias("tp"), F.sum(yhat * (1 - y)).alias("fp"),
              F.sum((1 - yhat) * (1 - y)).alias("tn"), F.sum((1 - yhat) * y).alias("fn"))

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    out = c.select(
        *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k) for k in ["rows", "tp", "fp", "tn", "fn"]])
    out = out.withColumns({
        "_p": F.col("tp") + F.col("fn"), "_n": F.col("tn") + F.col("fp"),
        "_a": F.col("tp") + F.col("fp")})
    return out.select(
        "rows", "tp", "fp", "tn", "fn",
        ratio("_p", "rows").alias("positive_rate"),
        ratio("_a", "rows").alias("alert_rate"),
        ratio("tp", "_p").alias("recall"),
        ratio("tp", "_a").alias("precision"),
        F.when((F.col("_p") > 0) & (F.col("_n") > 0),
               (F.col("tp") / F.col("_p") + F.col("tn") / F.col("_n")) / 2).alias("balanced_accuracy"),
        F.when(F.col("rows") > 0, (F.col("tp") + F.col("tn")) / F.col("rows")).otherwise(0.0).alias("accuracy"))


def evaluate(df: DataFrame, score: str = "risk_prob", label: str = "y_risk",
             threshold: float = C.ALERT_THRESHOLD) -> DataFrame:
    """M8-M11 in one row from one per-score table: ranking metrics, confusion counts at
    the threshold, the derived rates and whether both classes are present."""
    t = score_table(df, score, label)
    above = F.col("score") >= threshold
    a = t.agg(
        *_rank_sums(),
        F.coalesce(F.max("P"), F.lit(0)).alias("P"), F.coalesce(F.max("N"), F.lit(0)).alias("N"),
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias("fp"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    rows = F.col("P") + F.col("N")

    def ratio(x, y):
        return F.when(y > 0, x / y).otherwise(F.lit(0.0))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return a.select(
        F.when(ok, _auc()).alias("roc_auc"),
        F.when(ok, F.col("_ap") / F.col("P")).alias("average_precision"),
        rows.cast("bigint").alias("rows"), tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
        tn.cast("bigint").alias("tn"), fn.cast("bigint").alias("fn"),
        ratio(F.col("P"), rows).alias("positive_rate"),
        ratio(tp + fp, rows).alias("alert_rate"),
        ratio(tp, F.col("P")).alias("recall"),
        ratio(tp, tp + fp).alias("precision"),
        F.when(ok, (tp / F.col("P") + tn / F.col("N")) / 2).alias("balanced_accuracy"),
        ratio(tp + tn, rows).alias("accuracy"),
        ok.alias("evaluable"))


def evaluable(df: DataFrame, label: str = "y_risk") -> bool:
    """At least one row of each class."""
    row = df.agg(F.count(F.when(F.col(label) == 1, 1)).alias("p"),
                 F.count(F.when(F.col(label) == 0, 1)).alias("n")).first()
    return bool(row["p"]) and bool(row["n"])


def _quantile_columns(df: DataFrame, score: str, probs) -> list:
    qs = exact_quantiles(df, [score], list(probs))[score]
    return [F.lit(q).cast("double").alias(f"p{int(round(p * 100)):02d}") for p, q in zip(probs, qs)]


def score_quantiles(df: DataFrame, score: str = "risk_prob",
                    probs=tuple(C.SCORE_QUANTILES)) -> DataFrame:
    """Exact linear quantiles of the scores (p01, p05, p50, p95, p99), one row."""
    return df.agg(F.count(F.lit(1)).alias("_n")).select(*_quantile_columns(df, score, probs))


def score_summary(df: DataFrame, score: str = "risk_prob",
                  threshold: float = C.ALERT_THRESHOLD) -> DataFrame:
    """Rows scored, score percentiles and the share at or above the alert threshold."""
    s = df.select(S.nan_to_null(F.col(score).cast("double")).alias("s")).filter("s IS NOT NULL")
    return s.agg(F.count(F.lit(1)).cast("bigint").alias("rows_scored"),
                 F.avg((F.col("s") >= threshold).cast("double")).alias("share_flagged"),
                 *_quantile_columns(s, "s", C.SCORE_QUANTILES))
