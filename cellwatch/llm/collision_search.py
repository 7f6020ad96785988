"""Approximate nearest neighbours by collision counting over single projections (QALSH style).

Each of ``m`` hash functions is one random projection. A block of vectors is indexed by ``m``
sorted arrays, one for each projection. A query doesn't use fixed cells: on each array it opens
a window centred on its own projection, of half-width w * R / 2 for a radius R. Virtual rehashing
raises R by a factor and only the new ends of each window are read. A vector is counted once for
each window that holds it; when its count reaches the collision threshold, its exact distance is
computed. A query is done with a block when its k-th best distance is at most R, or when all
vectors of the block are verified; R never passes that distance.

A vector at distance s of the query falls in a window with probability
p(s) = P(abs(z) <= w * R / (2 * s)) for a normal z, so one at R collides on p1 * m arrays on
average (p1 = 0.83 at the default width). The threshold is the quantile of that binomial law
which a vector at R misses with probability ``MISS``, and a nearer one with less. Far vectors
collide less often and mostly stay under it. There is no cap on windows, collisions or
candidates: a very common vector or a query amid many rows costs more, and loses nothing.

Blocks are the Arrow batches a task reads, so all rows are indexed where they lie, nothing is
shuffled, and a very common vector is only more rows of several blocks. A task keeps its queries'
best from block to block and stops a query's windows by them. Queries are sent in blocks of
about ``QUERIES``, each a pass over the vectors: a stated query set against all rows. Each task returns
k + 1 rows a query at most and a ranking over these gives the result.

The recall is measured against brute force in the tests (0.9 is required).

Vectors that are null, empty, zero or hold null or non-finite components take no part. Vectors of
different lengths never meet. Equal distances rank by smaller vec_id, null ids last. Rows that
repeat a vec_id and vector are candidates each, but one query, which leaves out one such row as
its own. A null vec_id is no query. An empty table gives no rows. Only the id and the vector are
read, so other columns can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, table

PROJECTIONS = 96          # sorted arrays of a block
WIDTH = 2.72              # window width in radii: p1 = 0.826
MISS = 0.05               # chance that a neighbour at distance R stays under the threshold
GROWTH = 1.3              # of R, from round to round
QUERIES = 4096            # queries sent to the tasks at a time
TOGETHER = 128            # of these, searched in a block at a time
ROWS = 8192               # vectors of a block


def normal_share(x: float) -> float:
    """P(abs(z) <= x) for a standard normal z."""
    return math.erf(x / math.sqrt(2))


def collision_threshold(m: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """The most collisions of ``m`` that a vector at the radius reaches but with probability ``miss``."""
    p, below = normal_share(width / 2), 0.0
    for n in range(m + 1):
        below += math.comb(m, n) * p ** n * (1 - p) ** (m - n)
        if below > miss:
            return max(n, 1)
    return m


def projections(dim: int, m: int = PROJECTIONS, seed: int = 7) -> np.ndarray:
    """``m`` random directions; the same on every executor."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


class Block:
    """Vectors of one length with a sorted array for each projection."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, null: np.ndarray):
        self.x, self.ids, self.null = x, ids, null
        with np.errstate(over="ignore", invalid="ignore"):
            h = x @ projections(x.shape[1])
        h = np.nan_to_num(h)                               # overflow of huge components
        self.order = np.argsort(h, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(h, self.order.T, axis=0).T.copy()
        spread = float(np.median(self.sorted[:, -1] - self.sorted[:, 0]))
        self.unit = spread / 256 if spread > 0 else 1.0    # first radius

    def distances(self, q: np.ndarray, who: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            d = self.x[who] - q
            d *= d
            return np.sqrt(d.sum(axis=1))


class Best:
    """The nearest rows of one query so far: distance, id, null flag."""

    def __init__(self, k: int):
        self.k = k
        self.d, self.id, self.null = np.empty(0), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, d, ids, null) -> None:
        d, ids = np.concatenate([self.d, d]), np.concatenate([self.id, ids])
        null = np.concatenate([self.null, null])
        top = np.lexsort([ids, null, d])[:self.k]
        self.d, self.id, self.null = d[top], ids[top], null[top]

    def worst(self) -> float:
        return float(self.d[-1]) if len(self.d) == self.k else math.inf


def search_block(block: Block, queries: np.ndarray, best: list[Best], threshold: int) -> int:
    """Add the rows of ``block`` that collide with a query often enough; the number verified."""
    n, m = len(block.x), len(block.order)
    with np.errstate(over="ignore", invalid="ignore"):
        h = np.nan_to_num(queries @ projections(queries.shape[1]))
    counts = np.zeros((len(queries), n), np.int16)
    unseen = np.ones((len(queries), n), bool)
    lo = np.array([np.searchsorted(block.sorted[i], h[:, i]) for i in range(m)])
    hi = lo.copy()
    # Later blocks start where earlier ones ended: k rows at that distance are known.
    radius = np.array([b.worst() if math.isfinite(b.worst()) else block.unit for b in best])
    # Equal vectors may project apart by rounding.
    slack = 1e-12 * float(max(np.abs(block.sorted).max(), np.abs(h).max()))
    active, verified = np.arange(len(queries)), 0
    while len(active):
        half = WIDTH * radius[active] / 2 + slack
        a, b = lo[:, active].copy(), hi[:, active].copy()
        for i in range(m):
            values, at = block.sorted[i], h[active, i]
            np.minimum(a[i], np.searchsorted(values, at - half, "left"), out=a[i])
            np.maximum(b[i], np.searchsorted(values, at + half, "right"), out=b[i])
        more = []
        for c, j in enumerate(active):
            new = [block.order[i, x:y] for i, (x, y) in enumerate(zip(a[:, c], lo[:, j])) if x < y]
            new += [block.order[i, x:y] for i, (x, y) in enumerate(zip(hi[:, j], b[:, c])) if x < y]
            if new:
                counts[j] += np.bincount(np.concatenate(new), minlength=n).astype(np.int16)
            whole = not a[:, c].any() and (b[:, c] == n).all()          # windows hold all rows
            who = np.flatnonzero(unseen[j] if whole else unseen[j] & (counts[j] >= threshold))
            if len(who):
                unseen[j, who] = False
                verified += len(who)
                best[j].add(block.distances(queries[j], who), block.ids[who], block.null[who])
            if not whole and best[j].worst() > radius[j] and unseen[j].any():
                more.append(j)
        lo[:, active], hi[:, active] = a, b
        active = np.array(more, np.int64)
        if len(active):
            worst = np.array([best[j].worst() for j in active])
            radius[active] = np.minimum(radius[active] * GROWTH, worst)
    return verified


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and x (array of doubles) of the vectors that take part."""
    x = F.col(embedding).cast("array<double>")
    d = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).where(F.size("x") > 0)
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    return d.where(finite).where(F.exists("x", lambda v: v != 0))


def _arrays(batch):
    """(ids, null flags, {length: (places, matrix)}) of a batch with vec_id and x."""
    ids = batch.column(batch.schema.get_field_index("vec_id"))
    x = batch.column(batch.schema.get_field_index("x"))
    size = np.diff(x.offsets.to_numpy())
    flat, start = x.flatten().to_numpy(), np.r_[0, np.cumsum(size)]
    groups = {}
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        groups[int(dim)] = at, flat[start[at][:, None] + np.arange(dim)]
    return ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), groups


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id",
               embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (distance): the ``k`` nearest found of each query.

    ``queries`` are rows of ``vectors``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    asked = usable(queries, vec_id, embedding).where("vec_id IS NOT NULL").distinct()
    asked = asked.withColumn("key", F.xxhash64("vec_id", "x"))
    blocks = -(-asked.count() // QUERIES)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("query_id", T.LongType()),
                           T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod("key", F.lit(blocks)) == block).collect()          # about QUERIES rows
        sent = spark.sparkContext.broadcast([(r["key"], r["vec_id"], np.array(r["x"])) for r in part])
        here = map_arrow(rows, _searcher(sent, k + 1), schema)
        found = here if found is None else found.unionByName(here)
    if found is None:
        found = spark.createDataFrame([], schema)
    by_query = W.partitionBy("key").orderBy("score", F.asc_nulls_last("vec_id"))
    top = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k + 1)
    # The query's own row, if it is there, is the first with its id at distance 0.
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0)
    own_rank = F.min(F.when(own, F.col("rank"))).over(W.partitionBy("key"))
    after = F.when(F.col("rank") > F.coalesce(own_rank, F.lit(k + 2)), 1).otherwise(0)
    return top.withColumns({"own": own_rank, "place": F.col("rank") - after}).where(
        (F.col("own").isNull() | (F.col("rank") != F.col("own"))) & (F.col("place") <= k)).select(
        "query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")


def _searcher(sent, k: int):
    def run(batches):
        queries = sent.value
        best = [Best(k) for _ in queries]
        threshold = collision_threshold()
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                ids, null, groups = _arrays(batch.slice(i, ROWS))
                for dim, (at, x) in groups.items():
                    same = [j for j, (_, _, q) in enumerate(queries) if len(q) == dim]
                    block = Block(x, ids[at], null[at]) if same else None
                    for c in range(0, len(same), TOGETHER):
                        js = same[c:c + TOGETHER]
                        search_block(block, np.stack([queries[j][2] for j in js]), [best[j] for j in js], threshold)
        for (key, vec_id, _), b in zip(queries, best):
            if len(b.d):
                n = len(b.d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key, np.int64)), pa.array(np.full(n, vec_id, np.int64)),
                     pa.array(b.id, mask=b.null), pa.array(b.d)], ["key", "query_id", "vec_id", "score"])
    return run


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found of every row whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))
