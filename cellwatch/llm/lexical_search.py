"""Ranked lexical search by norm buckets (in the style of LEMP).

A document is a vector with an integer impact for each term, an item (query) one with a
weight w times the term's count; a score is their dot product. Both sides carry the square root
of w, which leaves the product as it is and lets rare terms shape the lengths.

- Each task orders its documents' vectors by length, longest first, and cuts them into buckets.
- An item meets a bucket only while its length times the bucket's greatest length reaches
  the item's threshold, the k-th best score that the task has so far (Cauchy-Schwarz).
- Inside a bucket, an item's few heaviest coordinates are multiplied out. What remains of both
  vectors bounds the rest of the product, again by Cauchy-Schwarz; rows whose bound stays under
  the threshold are dropped.
- The survivors' scores are computed exactly, in 64-bit integers, from all coordinates.

Every task returns its k best of each item, and a ranking over these few gives the result.
Bounds are doubles with a margin of 1e-9 and drop only what is strictly under the threshold, so
the result is exact. The order by length lies within a task: every task then has long and
short vectors and finds good thresholds, no vector is shuffled, and a group of copies is only
more rows.

Documents are split once, into a table of term counts in the shared folder. Only terms of items
stay, picked by a bit table of fixed size (1 MB), however many items there are; terms it lets
through by chance get no weight later. Items are searched in blocks of at most about ``BLOCK``
terms; a block is sent to all tasks and costs one pass over the table of counts.

Terms are told apart by 64-bit hashes. Null or empty text: no terms; such a document is not
counted and never found, such an item has no rows. Repeated documents are documents of
their own. Items that share id and text are one item; those that share only the id are ranked
each on its own. Equal scores rank by ascending doc_id, null ids last. Empty tables: no rows.
Only id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, row_key, table, written
from .textvec import ALNUM, Words, column_bytes, row_slices

BITS = 23                 # the filter of item terms has 2**BITS bits
BLOCK = 1 << 20           # item terms sent to the tasks at a time
BUCKET = 512              # vectors of a bucket
FOCUS = 5                 # coordinates that are multiplied out before the exact score
MARGIN = 1e-9             # of bounds, relative
#: Fixed values of the score: impact = SCALE * tf div (1000 * tf + 8 * m), m = 25 + 75 * n * N div L.
SCALE, TF_PART, LENGTH_PART, BASE, SLOPE = 1_000_000_000, 1000, 8, 25, 75


def term_counts(texts: DataFrame, keys: list[str], text: str, bits: np.ndarray | None = None) -> DataFrame:
    """``keys``, n (terms with repeats), terms (hashes) and tf of each text with a term.

    ``bits``: a filter from :func:`filter_bits`; terms outside it are counted in n alone.
    """
    source = texts.select(*keys, text)
    schema = T.StructType([*source.select(*keys).schema.fields, T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.LongType(), False)),
                           T.StructField("tf", T.ArrayType(T.LongType(), False))])
    shared = None if bits is None else texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            named = pa.Table.from_batches([batch]).select(keys)
            col = batch.column(batch.schema.get_field_index(text))
            _, off = column_bytes(col)
            for i, j in row_slices(off, 4 << 20):
                w = Words(col.slice(i, j - i), ALNUM)
                n = np.diff(w.row)
                row, h = np.repeat(np.arange(j - i), n), w.hash
                if shared is not None:
                    keep = _passes(h, shared.value)
                    row, h = row[keep], h[keep]
                order = np.lexsort([h, row])
                row, h = row[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.r_[at, len(h)])
                there = np.flatnonzero(n)
                size = np.bincount(row[at], minlength=j - i)[there]
                ends = pa.array(np.r_[0, np.cumsum(size)].astype(np.int32))
                rows = named.take(pa.array(there + i)).combine_chunks()
                if len(there):
                    yield pa.RecordBatch.from_arrays(
                        [*(c.chunk(0) for c in rows.columns), pa.array(n[there]),
                         pa.ListArray.from_arrays(ends, pa.array(h[at].view(np.int64))),
                         pa.ListArray.from_arrays(ends, pa.array(tf))], schema.names)

    return map_arrow(source, run, schema)


def _passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = h & np.uint64((1 << BITS) - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def filter_bits(terms: DataFrame) -> np.ndarray:
    """2**BITS bits in 64-bit words, those of the low bits of each ``term`` set."""
    low = F.col("term").bitwiseAND((1 << BITS) - 1)
    words = terms.select(F.shiftright(low, 6).alias("word"), F.expr(
        "shiftleft(1L, cast(term & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << BITS - 6, np.uint64)
    for r in words.collect():                              # 2**(BITS - 6) rows at most
        out[r["word"]] = r["bits"] & (1 << 64) - 1
    return out


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SCALE * tf // (TF_PART * tf + LENGTH_PART * m)


def length_norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents with ``n`` terms; exact also where n * docs passes 64 bits."""
    if len(n) and SLOPE * int(n.max()) * docs < 1 << 62:
        return BASE + SLOPE * n * docs // total
    return np.array([BASE + SLOPE * int(x) * docs // total for x in n], np.int64)


class Items:
    """A block of items: their terms in one sorted vocabulary, heaviest coordinates first."""

    def __init__(self, rows, k: int):
        """``rows``: (key, terms, counts, weights); terms without weight are left out."""
        self.k = k
        self.key = [r[0] for r in rows]
        self.vocabulary = np.unique(np.array([t for r in rows for t in r[1]], np.int64))
        self.weight = np.zeros(len(self.vocabulary), np.int64)
        self.terms, self.count, self.q, self.length, self.rest = [], [], [], [], []
        for _, terms, counts, weights in rows:
            at = np.searchsorted(self.vocabulary, np.array(terms, np.int64))
            c, w = np.array(counts, np.int64), np.array(weights, np.int64)
            self.weight[at] = w
            q = c * np.sqrt(w)
            o = np.argsort(-q, kind="stable")
            self.terms.append(at[o])
            self.count.append(c[o])
            self.q.append(q[o])
            self.length.append(math.sqrt(float((q * q).sum())))
            self.rest.append(math.sqrt(float((q[o][FOCUS:] ** 2).sum())))
        self.length = np.array(self.length)


class Best:
    """The k best (score, doc_id) of each item so far; null ids last among equals."""

    def __init__(self, items: Items):
        self.k = items.k
        self.score = [np.empty(0, np.int64) for _ in items.key]
        self.id = [np.empty(0, np.int64) for _ in items.key]
        self.null = [np.empty(0, bool) for _ in items.key]
        self.threshold = np.zeros(len(items.key))          # 0: fewer than k found

    def add(self, item: int, score, ids, null) -> None:
        s = np.concatenate([self.score[item], score])
        i, z = np.concatenate([self.id[item], ids]), np.concatenate([self.null[item], null])
        top = np.lexsort([i, z, -s])[:self.k]
        self.score[item], self.id[item], self.null[item] = s[top], i[top], z[top]
        if len(top) == self.k:
            self.threshold[item] = s[top[-1]]


class Buckets:
    """Vectors of some documents in buckets by length, longest first."""

    def __init__(self, row, term, tf, m, n_rows: int, items: Items):
        value = impacts(tf, m[row])
        scaled = value * np.sqrt(items.weight[term])
        length = np.sqrt(np.bincount(row, weights=scaled * scaled, minlength=n_rows))
        self.rows = np.argsort(-length, kind="stable")     # documents by length
        self.rows = self.rows[:int((length > 0).sum())]
        place = np.full(n_rows, -1, np.int64)
        place[self.rows] = np.arange(len(self.rows))
        self.length = length[self.rows]
        at = place[row]
        keep = at >= 0
        at, term, value, scaled = at[keep], term[keep], value[keep], scaled[keep]
        o = np.lexsort([at, term, at // BUCKET])
        self.at, self.term, self.value, self.scaled = at[o], term[o], value[o], scaled[o]
        self.cut = np.searchsorted(self.at // BUCKET, np.arange(-(-len(self.rows) // BUCKET) + 1))

    def __len__(self):
        return len(self.cut) - 1


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all ranges lo:hi one after another, and the range of each."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + (lo - np.r_[0, np.cumsum(n)[:-1]])[of], of


def search_buckets(b: Buckets, items: Items, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
    """Add what ``b`` holds to ``best``; the number of exact scores computed."""
    exact = 0
    for k in range(len(b)):
        first = k * BUCKET
        length = b.length[first:first + BUCKET]
        reach = items.length * (length[0] * (1 + MARGIN))
        alive = np.flatnonzero(reach >= best.threshold)
        if not len(alive):
            break                                          # later buckets are shorter
        part = slice(b.cut[k], b.cut[k + 1])
        at, term = b.at[part] - first, b.term[part]
        value, scaled = b.value[part], b.scaled[part]
        for i in alive:
            terms = items.terms[i]
            lo, hi = np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right")
            inside = np.ones(len(length), bool)
            if best.threshold[i]:
                p, of = _spans(lo[:FOCUS], hi[:FOCUS])
                row, x = at[p], scaled[p]
                done = np.bincount(row, weights=x * items.q[i][of], minlength=len(length))
                left = length * length - np.bincount(row, weights=x * x, minlength=len(length))
                bound = done + items.rest[i] * np.sqrt(np.maximum(left, 0) + MARGIN * length * length)
                inside = bound * (1 + MARGIN) >= best.threshold[i]
                if not inside.any():
                    continue
            p, of = _spans(lo, hi)
            p, of = p[inside[at[p]]], of[inside[at[p]]]
            score = np.zeros(len(length), np.int64)
            np.add.at(score, at[p], value[p] * items.weight[terms[of]] * items.count[i][of])
            exact += int(inside.sum())
            good = np.flatnonzero((score > 0) & (score >= best.threshold[i]))
            if len(good):
                who = b.rows[first + good]
                best.add(i, score[good], ids[who], null[who])
    return exact


def weighted_items(items: DataFrame, frequency: DataFrame, docs: int) -> DataFrame:
    """key, terms, counts, weights of each item, from term counts and the documents' frequencies."""
    w = F.floor(1000 * F.log((2.0 * docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    each = items.select("key", F.explode(F.arrays_zip("terms", "tf")).alias("x")).select(
        "key", F.col("x.terms").alias("term"), F.col("x.tf").alias("count"))
    each = each.join(frequency.select("term", w.alias("w")), "term").where("w > 0")
    return each.groupBy("key").agg(F.collect_list(F.struct("term", "count", "w")).alias("x")).select(
        "key", F.col("x.term").alias("terms"), F.col("x.count").alias("counts"), F.col("x.w").alias("weights"))


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item.

    ``documents``: doc_id (integer), text; ``items``: item_id, text.
    """
    spark = documents.sparkSession
    keyed = items.select("item_id", "text", row_key(F.col("item_id"), F.col("text")).alias("key"))
    named = keyed.select("key", "item_id").distinct()
    queries = written(term_counts(keyed.dropDuplicates(["key"]), ["key"], "text"), "item-terms")
    vocabulary = queries.select(F.explode("terms").alias("term")).distinct()
    counts = written(term_counts(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                                 ["doc_id"], "text", filter_bits(vocabulary)), "term-counts")
    docs, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"))
    vectors = written(weighted_items(queries, frequency, docs), "item-vectors")
    size = vectors.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("score", T.LongType())])
    found = None
    for block in range(blocks):
        rows = vectors.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()     # about BLOCK terms
        if not rows:
            continue
        part = map_arrow(counts, _searcher(spark.sparkContext.broadcast(Items(rows, k)), docs, total), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    order = W.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(named, "key").select("item_id", "rank", "doc_id", "score")


def _searcher(shared, docs: int, total: int):
    def run(batches):
        items = shared.value
        best = Best(items)
        for batch in batches:
            terms, tf = batch.column(batch.schema.get_field_index("terms")), batch.column(batch.schema.get_field_index("tf"))
            size = np.diff(terms.offsets.to_numpy())
            term, tf = terms.flatten().to_numpy(), tf.flatten().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(items.vocabulary, term), len(items.vocabulary) - 1)
            known = (items.vocabulary[at] == term) & (items.weight[at] > 0)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            null = ids.is_null().to_numpy(zero_copy_only=False)
            m = length_norms(batch.column(batch.schema.get_field_index("n")).to_numpy(), docs, total)
            b = Buckets(row[known], at[known], tf[known], m, len(size), items)
            search_buckets(b, items, best, ids.fill_null(0).to_numpy(), null)
        for i, key in enumerate(items.key):
            if len(best.score[i]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.score[i]), key, np.int64)),
                     pa.array(best.id[i], mask=best.null[i]), pa.array(best.score[i])], ["key", "doc_id", "score"])
    return run


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
),
sizes AS (SELECT count(*) AS docs, sum(len(t)) AS total FROM d WHERE len(t) > 0),
post AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM post, sizes GROUP BY term, docs
),
items AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
),
norms AS (SELECT k, doc_id, 25 + (75 * len(t) * docs) // total AS m FROM d, sizes WHERE len(t) > 0),
scored AS (
  SELECT item_id, k, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN post USING (term) JOIN norms USING (k) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""
