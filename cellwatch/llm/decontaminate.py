"""Benchmark decontamination by winnowing.

Words are hashed, and k consecutive words make a gram. Of every w consecutive grams the
smallest hash is kept (the last of equals): any run of k + w - 1 shared words keeps the same
gram on both sides, so joining the kept grams of documents and items finds every shared window
of that many words. Each found gram is then extended to the windows it stands for: a window
belongs to the gram kept for it, the gram's row carries the hashes of its windows, and those
are joined with the items' windows. All joins are on hashes; no pair of texts is formed.

A window is ``window`` words of an item; an item with fewer words is one window. Shorter items
are winnowed by their own length, so they are found by the same joins: one set of grams for
each length that occurs (``window`` at most).

Null or empty text: no words, never contaminated, and an item without words has no window. A
null item id counts as an empty one. Documents that share id and text share their hits. Very long texts are winnowed whole; of equal hashes the last is kept.
Empty tables give empty or clean results, and other columns stay, whatever their names. A
gram that very many documents share only adds rows that hash to its place: the items' side
has each gram once, so no key multiplies rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extended, map_arrow, private, release_driver_memory, row_key, table, written
from .textvec import ALNUM, Words, column_bytes, grams, row_slices

WINDOW = 10               # words of a window
GRAM = 5                  # words of a gram
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"     # before lower-casing A-Z


def winnow(g: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest of each w consecutive hashes, the last of equals."""
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, w):
        here = g[j:j + n]
        new = here <= best
        best[new] = here[new]
        at[new] = np.flatnonzero(new) + j
    return at


def kept_grams(w: Words, length: int):
    """Grams kept for windows of ``length`` words and the windows that each stands for.

    (text, gram hash, first word's place of the first window, number of windows) of each kept
    gram, and the hashes of all windows in order.
    """
    k = min(GRAM, length)
    n = len(w.hash) - length + 1
    if n <= 0:
        e = np.empty(0, np.int64)
        return e, np.empty(0, np.uint64), e, e, np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(w.row) - 1), np.diff(w.row))
    inside = text[:n] == text[length - 1:]
    g = grams(w.hash, k, salt=length)
    at = winnow(g, length - k + 1)[inside]
    start = np.flatnonzero(inside)
    windows = grams(w.hash, length, salt=64 + length)[inside]
    new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.empty(0, bool)
    new[1:] |= start[1:] != start[:-1] + 1
    first = np.flatnonzero(new)
    of = text[start[first]]
    return of, g[at[first]], start[first] - w.row[of], np.diff(np.r_[first, len(at)]), windows


def fingerprints(texts: DataFrame, keys: list[str], text: str, lengths: list[int]) -> DataFrame:
    """A row for each kept gram: ``keys``, length, gram, at (first window's word), windows."""
    lengths = sorted(lengths)
    source = texts.select(*keys, text)
    schema = T.StructType([*source.select(*keys).schema.fields, T.StructField("length", T.IntegerType()),
                           T.StructField("gram", T.LongType()), T.StructField("at", T.LongType()),
                           T.StructField("windows", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            whole = pa.Table.from_batches([batch]).select(keys)
            col = batch.column(batch.schema.get_field_index(text))
            _, off = column_bytes(col)
            for i, j in row_slices(off, 4 << 20):
                w = Words(col.slice(i, j - i), ALNUM)
                for length in lengths:
                    of, gram, at, n, windows = kept_grams(w, length)
                    if not len(of):
                        continue
                    listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)),
                                                      pa.array(windows.view(np.int64)))
                    named = whole.take(pa.array(of + i)).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [*(c.chunk(0) for c in named.columns), pa.array(np.full(len(of), length, np.int32)),
                         pa.array(gram.view(np.int64)), pa.array(at), listed], schema.names)

    return map_arrow(source, run, schema)


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """item, length, gram, window: every window of every item, written to the shared folder.

    Also the lengths that occur.

    ``items``: item_id, text.
    """
    d = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                     F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("_n", F.least(F.regexp_count("text", F.lit(WORD)), F.lit(window))).where("_n > 0")
    lengths = [r["_n"] for r in d.select("_n").distinct().collect()]        # ``window`` values at most
    parts = [fingerprints(d.where(F.col("_n") == length), ["item"], "text", [length]) for length in lengths]
    if not parts:
        parts = [fingerprints(d, ["item"], "text", [window])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = written(out.select("item", "length", "gram", F.explode("windows").alias("window")).distinct(),
                  "items-windows")
    return out, sorted(lengths)


def hit_windows(docs: DataFrame, found: DataFrame, lengths: list[int]) -> DataFrame:
    """key, at, length, window of each window of an item that occurs in a document.

    ``docs``: key columns doc_id and _k, and text; ``found`` and ``lengths``: from :func:`item_windows`.
    """
    kept = fingerprints(docs, ["doc_id", "_k"], "text", lengths)
    grams_ = found.select("length", "gram").distinct()
    kept = kept.join(grams_, ["length", "gram"], "left_semi")
    seen = kept.select("doc_id", "_k", "length", "at", F.posexplode("windows").alias("p", "window"))
    seen = seen.select("doc_id", "_k", "length", (F.col("at") + F.col("p")).alias("at"), "window")
    return seen.join(found.select("length", "window").distinct(), ["length", "window"], "left_semi")


def word_counts(col) -> np.ndarray:
    """Number of words of each row of a string column; null has none."""
    raw, off = column_bytes(col)
    out = np.zeros(len(off) - 1, np.int64)
    for i, j in row_slices(off, 4 << 20):
        inside = ALNUM[raw[off[i]:off[j]]] != 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        first = off[i:j] - off[i]
        first = first[first < len(inside)]
        starts[first] = inside[first]                      # a word doesn't run over from the row before
        sums = np.zeros(len(inside) + 1, np.int64)
        np.cumsum(starts, out=sums[1:])
        out[i:j] = np.diff(sums[off[i:j + 1] - off[i]])
    return out


def counted(docs: DataFrame, key: str, drop: tuple[str, ...]) -> DataFrame:
    """``docs`` without the columns ``drop``, with ``key`` (see ``row_key``) and n_words."""
    source = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    kept = [c for c in source.columns if c not in drop]
    schema = extended(source.select(*kept).schema, n_words=T.LongType())

    def run(batches):
        for batch in batches:
            n = word_counts(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(n)], [*kept, "n_words"])

    return map_arrow(source, run, schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated instead of same-named columns.

    ``docs`` has doc_id and text. ``drop``: columns that the result does without, such as the
    texts, which are not moved then.
    """
    results = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.select(*[c for c in docs.columns if c not in results])
    keep = [c for c in docs.columns if c not in drop]
    k, doc, k2, listed = private(docs.columns, "_k", "_d", "_k2", "_items")
    d = counted(docs, k, tuple(c for c in drop if c != "doc_id"))
    texts = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("_k"), "text")
    found, lengths = item_windows(items, window)
    if not lengths:
        hits = written(texts.select("doc_id", "_k", F.lit(0).alias("length"), F.lit(0).cast("long").alias("window"),
                                    F.lit(0).cast("long").alias("at")).limit(0), "hit-windows")
    else:
        hits = written(hit_windows(texts, found, lengths).distinct(), "hit-windows")
    release_driver_memory(docs.sparkSession)
    # Words inside any hit window: each window adds what reaches past the ones before it.
    spans = hits.select("doc_id", "_k", "at", (F.col("at") + F.col("length")).alias("end")).groupBy(
        "doc_id", "_k", "at").agg(F.max("end").alias("end"))
    before = W.partitionBy("doc_id", "_k").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("_b", F.coalesce(F.max("end").over(before), F.lit(0)))
    words = spans.groupBy("doc_id", "_k").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("at", "_b"))).cast("long").alias("n_hit"))
    named = hits.select("doc_id", "_k", "length", "window").distinct().join(
        found.select("length", "window", "item").distinct(), ["length", "window"])
    named = named.groupBy("doc_id", "_k").agg(F.array_sort(F.collect_set("item")).alias("_items"))
    hit = words.join(named, (words["doc_id"].eqNullSafe(named["doc_id"])) & (words["_k"] == named["_k"])).select(
        words["doc_id"].alias(doc), words["_k"].alias(k2), "n_hit", F.col("_items").alias(listed))
    none = F.expr("cast(array() as array<string>)")
    out = d.join(hit, d["doc_id"].eqNullSafe(hit[doc]) & (d[k] == hit[k2]), "left")
    items_ = F.coalesce(listed, none)
    return out.select(
        *keep, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document stands in the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark"), drop=("text",))


OP2_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM item_words WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
doc_windows AS (
  SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM lowered, (SELECT DISTINCT n FROM sized) WHERE w IS NOT NULL AND len(w) >= n)
),
hits AS (SELECT k, n, i, item FROM doc_windows JOIN item_windows USING (n, words)),
covered AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS place FROM hits) GROUP BY k),
named AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, coalesce(item, '') AS item FROM hits) GROUP BY k
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM lowered LEFT JOIN covered USING (k) LEFT JOIN named USING (k)"""
