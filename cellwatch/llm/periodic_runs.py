"""Periodic stretches of words, found by a dictionary of basic factors.

A run is a stretch of words with smallest period q (words q apart are equal) that holds its
period ``exponent`` times at least, has ``least`` words at least and can't be made longer on
either side. The basic factors of a text are its stretches of 1, 2, 4, ... words. All that are
equal get one name: a factor of 2L words is named by the pair of names of its halves, so a
level costs one sort. Places that share a name are listed in order. Where two successive ones
stand within twice the factor's length, they are a step of an arithmetic progression, and the
step is a proposed period: for L/2 < q <= L, L words that occur again q words later and not
before have the smallest period q. Places with equal steps that follow one another make a
stretch, which is extended while words q apart stay equal, and equal stretches are one run.

Every run is found: with L the smallest power of two not under q, each of its places up to
q + L words before its end starts a factor whose next occurrence is q words on, since two
nearer ones would give the run a smaller period. That needs a run of q + L < 3q words, so
``exponent`` is 3 at least. A factor that occurs once can't be part of a longer one that
occurs twice, so only repeated ones go to the next level, and texts without repeats end early.

All of it is numpy on slices of whole texts: a text's runs depend on the text alone, so rows
are never shuffled and a hot group of copies is only more rows. Memory is a small multiple of a
slice, or of one text where that is longer. Words are told apart by 64-bit hashes.

Null or empty text: no words, no runs, empty collapsed text. Repeated rows and null ids: a row
each. Ties for a text's strongest run: the smallest start, then the smallest period. An empty
table gives an empty result. Columns named as results are replaced, all others stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extended, map_arrow, table
from .textvec import SPACED_CASED, Words, column_bytes, mix, row_slices

LEAST = 6                 # words of a run
EXPONENT = 4              # times that a run holds its period
SLICE = 4 << 20           # bytes of texts handled at a time
RUN = T.StructType([T.StructField(k, T.LongType(), False) for k in ("start", "length", "period")])


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``keys`` (equals by place), where a new key starts in it, and a name for each key."""
    order = np.argsort(keys, kind="stable")
    there = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(there[1:], there[:-1], out=new[1:])
    name = np.empty(len(keys), np.int64)
    name[order] = np.cumsum(new) - 1
    return order, new, name


def proposals(h: np.ndarray, row: np.ndarray, exponent: int = EXPONENT):
    """(first place, last place, period, factor length) of each progression of equal factors.

    ``h``: hashes of the words of some texts; text i has ``row[i]:row[i+1]``.
    """
    size = np.diff(row)
    text = np.repeat(np.arange(len(size)), size)
    end, words = row[1:][text], size[text]
    at = before = np.flatnonzero(words >= exponent)
    key = mix(h[at] + mix(text[at].astype(np.uint64)))
    name = np.full(len(h), -1, np.int64)
    length = 1
    while len(at):
        order, new, found = _named(key)
        place, step = at[order], np.empty(len(at), np.int64)
        step[:-1] = place[1:] - place[:-1]
        step[-1:] = 0
        last = np.ones(len(at), bool)
        last[:-1] = new[1:]
        near = ~last & (step <= length) & (2 * step > length)
        first, period = place[near], step[near]
        o = np.argsort(first)
        first, period = first[o], period[o]
        if len(first):
            cut = np.flatnonzero(np.r_[True, (first[1:] != first[:-1] + 1) | (period[1:] != period[:-1])])
            yield first[cut], first[np.r_[cut[1:], len(first)] - 1], period[cut], length
        repeated = np.empty(len(at), bool)
        repeated[order] = ~(new & last)
        name[before] = -1
        name[at] = np.where(repeated, found, -1)
        go = at[repeated & (at + 2 * length <= end[at]) & (exponent * (length + 1) <= words[at])]
        go = go[name[go + length] >= 0]
        key = name[go] << 32 | name[go + length]
        before, at, length = at, go, 2 * length


def find_runs(h: np.ndarray, row: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (text, start, end, period) of all runs, in this order; places count in the slice."""
    size = np.diff(row)
    text = np.repeat(np.arange(len(size)), size)
    found = [np.empty((0, 4), np.int64)]
    for first, last, q, length in proposals(h, row, exponent):
        s, e = first.copy(), last + q + length
        of = text[s]
        while True:                                        # extend to the left
            more = np.flatnonzero(s > row[of])
            more = more[h[s[more] - 1] == h[s[more] - 1 + q[more]]]
            if not len(more):
                break
            s[more] -= 1
        while True:                                        # and to the right
            more = np.flatnonzero(e < row[of + 1])
            more = more[h[e[more]] == h[e[more] - q[more]]]
            if not len(more):
                break
            e[more] += 1
        keep = e - s >= np.maximum(least, exponent * q)
        found.append(np.column_stack([of, s, e, q])[keep])
    return np.unique(np.concatenate(found), axis=0)


def _order(runs: np.ndarray) -> np.ndarray:
    """By text, start, period."""
    return runs[np.lexsort([runs[:, 3], runs[:, 1], runs[:, 0]])]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST,
                  exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period by start, then period) and
    collapsed: the words that no run holds after its first period, joined by one space.
    """
    if exponent < 3:
        raise ValueError("a run must hold its period three times at least")
    results = ["n_words", "runs", "collapsed"]
    source = docs.select(*[c for c in docs.columns if c not in results])

    def run(batches):
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            raw, off = column_bytes(col)
            for i, j in row_slices(off, SLICE):
                w = Words(col.slice(i, j - i), SPACED_CASED)
                runs = _order(find_runs(w.hash, w.row, least, exponent))
                s, e, q = runs[:, 1], runs[:, 2], runs[:, 3]
                change = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(change, s + q, 1)
                np.add.at(change, e, -1)
                kept = np.cumsum(change)[:-1] == 0
                count = np.bincount(runs[:, 0], minlength=j - i)
                texts = []
                for k in range(j - i):
                    words = raw[off[i + k]:off[i + k + 1]].tobytes().split()
                    if count[k]:
                        words = [x for x, here in zip(words, kept[w.row[k]:w.row[k + 1]].tolist()) if here]
                    texts.append(b" ".join(words))
                fields = [pa.array(s - w.row[runs[:, 0]]), pa.array(e - s), pa.array(q)]
                listed = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)),
                    pa.StructArray.from_arrays(fields, fields=[pa.field(f, pa.int64(), False)
                                                               for f in ("start", "length", "period")]))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(w.row)), listed, pa.array(texts, pa.binary()).view(pa.string())],
                    [*batch.schema.names, *results])

    return map_arrow(source, run, extended(source.schema, n_words=T.LongType(),
                                           runs=T.ArrayType(RUN, False), collapsed=T.StringType()))


def strongest(runs):
    """The run with the greatest length / period, compared exactly; null without runs."""
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where one id in ten has a text made periodic from some word on.

    With h the crc32 of the id in decimals, g = h div 10, n words: if h % 10 = 0 and n > 0, word
    i >= a becomes word a + (i - a) % p; a = g % n, p = 1 + (n - a) div (3 + g % 8). A null id
    has no h and its text stays.
    """
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    d = d.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    d = d.withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
    d = d.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    times = "cast((n - a) div p + 1 as int)"
    whole = F.expr(f"concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), {times})), 1, n - a))")
    planted = F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text"))
    return d.select("doc_id", planted.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, periods planted in one id of ten, with digests."""
    docs = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
