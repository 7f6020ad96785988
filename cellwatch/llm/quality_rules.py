"""Quality rules learned from labelled statistics, emitted as one Spark conditional expression.

Method (sequential covering): the labelled rows are split by a hash of the id into a part
to grow on and a part to prune on. A rule for low quality grows from the empty conjunction
by the threshold condition with the largest information gain; candidate thresholds are
quantiles of each statistic, and one grouped count gives the gain of all of them at once.
The grown rule is cut back to the prefix of its conditions that is most precise on the other
part. Rows it covers are removed and the next rule is grown, until no rule is precise
enough. The ordered rules become ``CASE WHEN ... THEN false ... ELSE true END``.

Everything is DataFrame operations; only counts of (statistic, bin) cells, whose number does
not depend on the data, come back to the driver.

Null or empty text: no words, all statistics 0, base_failed. Rows with a null id are judged
like others and never used for learning; null labels are left out; without any label (or
only one kind) there are no rules and only the base decides. Repeated rows are judged each. Very
long texts are counted whole. Of conditions with equal gain the first statistic and threshold is
taken. An empty table gives an empty result. Columns of the input that bear a result's name are
replaced, all others stay, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_WORD, drop_written, table, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = ["words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
              "upper_share", "short_share", "mark_share"]

BINS = 64              # quantile bins of a statistic
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_COVER = 10         # rows a rule covers, at least, in the part it is grown on
MIN_PRECISION = 0.9    # of a rule on the part it is pruned on


def three_word_windows(words: Column) -> Column:
    """Hash of each window of three words (words' hashes, chained), null for fewer words."""
    n = F.size(words)
    h = F.transform(words, lambda x: F.xxhash64(x))
    two = F.zip_with(h, F.slice(h, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(two, F.slice(h, F.lit(3), n), lambda a, b: F.xxhash64(a, b))
    return F.when(n >= 3, F.slice(three, F.lit(1), n - 2))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with COUNTS and STATISTICS of each row's whole text."""
    keep = [c for c in docs.columns if c != text and c not in COUNTS + STATISTICS]
    # The kept columns go along as one, so that no name of theirs clashes with one used here.
    kept, keep = [F.col(f"_row.`{c}`") for c in keep], ["_row"]
    row = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns if c != text and c not in COUNTS + STATISTICS])
    d = docs.select(row.alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = d.withColumn("_words", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+", -1), ""))
    w, x = F.col("_words"), F.col("_text")
    lines = F.filter(F.split(x, "\n", -1), lambda v: v.rlike(SPACE_WORD))
    d = d.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(x, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.regexp_count(x, F.lit(r"[A-Z]")).alias("_upper"),
        F.regexp_count(x, F.lit(r"[!?.,;:]")).alias("_marks"),
        F.size(F.filter(w, lambda v: F.length(v) <= 3)).alias("_short"),
        three_word_windows(w).alias("_windows"))
    # Only texts with a repeated window need places: (hash, place) in order of hash puts equal
    # windows side by side; each repeated window adds the words up to the next one, three at most.
    win = F.col("_windows")
    placed = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_placed", F.when(F.size(F.array_distinct(win)) < F.size(win), placed))
    p = F.col("_placed")
    at = F.filter(p, lambda v, i: ((i > 0) & (v["h"] == F.get(p, i - 1)["h"]))
                  | (v["h"] == F.get(p, i + 1)["h"]))
    d = d.withColumn("_at", F.when(p.isNotNull(), F.sort_array(F.transform(at, lambda v: v["i"]))))
    a = F.col("_at")
    covered = F.aggregate(
        F.zip_with(a, F.slice(a, F.lit(2), F.size(a)), lambda u, v: F.coalesce(F.least(v - u, F.lit(3)), F.lit(3))),
        F.lit(0), lambda total, v: total + v)
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(a.isNotNull(), covered), F.lit(0)).cast("long"))
    return d.select(
        *kept, *COUNTS,
        F.col("n_words").cast("double").alias("words"),
        (F.col("word_chars") / n).alias("mean_word"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / n).alias("dup_line_share"),
        (F.col("n_repeat_words") / n).alias("repeat_share"),
        (F.col("_upper") / chars).alias("upper_share"),
        (F.col("_short") / n).alias("short_share"),
        (F.col("_marks") / n).alias("mark_share"))


def base_failed() -> Column:
    """Under 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``statistic >= threshold`` (or ``<``)."""

    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c >= self.threshold if self.at_least else c < self.threshold

    def __str__(self):
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in conditions), F.lit(True))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gained about low quality by covering p of p0 low and n of n0 other rows."""
    if p <= 0:
        return -1.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best_condition(rows: DataFrame, edges: dict[str, list[float]]):
    """The condition of most gain over ``rows`` (columns STATISTICS, _low), and what it covers.

    One job: each row adds to one bin of each statistic; the driver gets a count for each
    (statistic, bin).
    """
    def bin_of(s: str) -> Column:
        value = F.col(s)
        return F.size(F.filter(F.array(*map(F.lit, edges[s])), lambda e: e <= value))

    named = [F.struct(F.lit(s).alias("s"), bin_of(s).alias("b")) for s in STATISTICS if edges[s]]
    cells = (rows.select("_low", F.explode(F.array(*named)).alias("c"))
             .groupBy("c.s", "c.b").agg(F.sum("_low").alias("p"), F.count("*").alias("t")).collect())
    best = (0.0, None, 0, 0)
    for s in STATISTICS:
        by_bin = {r["b"]: (r["p"], r["t"] - r["p"]) for r in cells if r["s"] == s}
        p0, n0 = (sum(v[k] for v in by_bin.values()) for k in (0, 1))
        if not p0:
            continue
        p = n = 0
        for b, edge in enumerate(edges[s]):     # bin b lies below edge b
            dp, dn = by_bin.get(b, (0, 0))
            p, n = p + dp, n + dn
            for low, other, at_least in ((p, n, False), (p0 - p, n0 - n, True)):
                if low + other >= MIN_COVER and (g := _gain(low, other, p0, n0)) > best[0]:
                    best = (g, Condition(s, at_least, edge), low, other)
    return best


def learn_rules(stats: DataFrame, low: str = "_low", part: str = "_grow") -> list[list[Condition]]:
    """Ordered rules for low quality.

    ``stats``: STATISTICS, ``low`` (1: low quality, 0: not) and ``part`` (true: grow, false:
    prune). Thresholds lie between values, at quantiles of the labelled rows.
    """
    stats = stats.select(*STATISTICS, F.col(low).cast("long").alias("_low"), F.col(part).alias("_grow"))
    shares = [i / BINS for i in range(1, BINS)]
    q = stats.agg(*[F.percentile_approx(s, shares, 10_000).alias(s) for s in STATISTICS]).first()
    edges = {s: sorted({float(v) for v in q[s] or [] if v is not None}) for s in STATISTICS}
    edges = {s: e + [math.nextafter(e[-1], math.inf)] if e else [] for s, e in edges.items()}
    rules: list[list[Condition]] = []
    rest = stats
    if not any(edges.values()):
        return rules
    while len(rules) < MAX_RULES:
        grow, rule, covered = rest.where("_grow"), [], F.lit(True)
        while len(rule) < MAX_CONDITIONS:
            gain, condition, p, n = _best_condition(grow.where(covered), edges)
            if condition is None:
                break
            rule.append(condition)
            covered = _all(rule)
            if n == 0:
                break
        if not rule:
            break
        held = rest.where(~F.col("_grow")).agg(*[
            f for i in range(1, len(rule) + 1) for f in (
                F.sum(F.when(_all(rule[:i]), F.col("_low"))).alias(f"p{i}"),
                F.count(F.when(_all(rule[:i]), 1)).alias(f"t{i}"))]).first()
        precise = [((held[f"p{i}"] or 0) + 0.0) / held[f"t{i}"] if held[f"t{i}"] else 0.0
                   for i in range(1, len(rule) + 1)]
        most = max(precise)
        if most < MIN_PRECISION:
            break
        rule = rule[:precise.index(most) + 1]
        rules.append(rule)
        rest = rest.where(~_all(rule))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """True unless a rule covers the row; the rules are asked in order."""
    if not rules:
        return F.lit(True)
    out = F.when(_all(rules[0]), F.lit(False))
    for rule in rules[1:]:
        out = out.when(_all(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of each row of ``docs``.

    ``labels``: doc_id and quality (0: low). The statistics are computed once and written
    to the shared folder; the rules are learnt from all labelled rows of that table.
    """
    stats = written(statistics(docs, text), "quality-statistics")
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_q"))
             .where("_id IS NOT NULL AND _q IS NOT NULL").groupBy("_id").agg(F.min("_q").alias("_q")))
    labelled = written(
        stats.select("doc_id", *COUNTS, *STATISTICS).join(known, F.col("doc_id") == F.col("_id")).where(
            ~base_failed()).select(
            *STATISTICS, (F.col("_q") == 0).cast("long").alias("_low"),
            (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0).alias("_grow")),
        "quality-labelled")
    rules = learn_rules(labelled)
    drop_written(labelled)
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the learned decision list's verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", *STATISTICS)
