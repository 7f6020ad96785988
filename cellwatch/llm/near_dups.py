"""Near-duplicate groups from bottom-k sketches.

One hash function orders all shingles (five words; a shorter text is one shingle). A document's
sketch is its ``SKETCH`` smallest shingle hashes, or its whole set where that is smaller.

1. Documents with equal sets form a class; the one with the smallest id stands for it.
2. Inverted lists: sketch values, the document's rarest first, are posted for so many of them
   that two linked documents must share one. (A global order and the least overlap that linked
   sketches have make that a pigeonhole argument. The order comes from a fixed-size table of
   counts; any order gives the same result.) Values that very many documents share come last
   and are posted only by documents made of little else.
   Lists of one member are dropped at once; sketches are kept on only for documents in the
   lists that remain.
3. Two rounds compare every member of a list with one member of it (the smallest id, then the
   smallest hash), which joins most groups without forming their pairs. What is left are
   lists with members in several components (of equal lists one): there, members outside the
   list's largest component are compared with the others, by a self-join in lists of at most
   ``FEW`` members and by products of membership matrices, block by chunk, in longer ones.
   Longer lists with a common member are compared as one list where that is less work: a
   large family has many lists of nearly the same members. Of a large family there remain pairs in
   proportion to its square, which overlap nearly enough: where they are many, they stay in their
   block and chunk, a row for each document and not for each pair, and full sets come to them.
   A pair is given by the first value that both documents post, not by every list they share.
4. A pair passes if its union sketch, the smallest values of both sketches, estimates enough
   overlap: first by ``TINY`` values, so that little is moved for the many pairs that share
   a passage, then by ``SKETCH`` (or, where both sketches are whole sets, by the similarity
   itself). It is a link if the exact Jaccard similarity of the full sets is ``SIMILAR`` percent
   or more. Full sets are made anew from the texts that a round still asks for. Pairs with a
   common neighbour are compared in one task, so that a sketch or set moves once for many
   pairs: of the pairs inside a large family there may be as many as its square.
5. Components by hooking to the smallest neighbour and jumping pointers. Labels are carried from
   round to round: a round's links join the components before it. Tables and shuffle files go
   as soon as what follows is written.

The least overlaps of two incomplete sketches of linked sets are bounds in probability: at
similarity 0.75 exactly, a pair's union sketch shares fewer than ``LEAST`` of ``SKETCH`` values,
or ``LEAST_TINY`` of ``TINY``, with a probability under 1e-6 (4.9 and over 5 standard
deviations), less above it. Whole sets have
no such error. In long lists a pair is judged by all values of both sketches up to the
smaller one's largest, u of them: fewer than ``LEAST_OF[u]`` are shared with a probability under 6e-9
for each u, so under 1e-6 for all.

Very long texts are read whole, in slices. An empty table gives an empty result. Null text or no words: empty set, no links, component its own id. Rows with one id are one
document; rows without id have no component and are kept. Repeated rows keep their number.
Columns of the input that bear a result's name are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_written, map_arrow, release_driver_memory, release_memory, ship, shuffles_dropped, table, written
from .textvec import SPACED, Words, column_bytes, grams, mix, row_slices

SHINGLE = 5               # words
SIMILAR = 75              # percent
SKETCH = 160              # values of a sketch
LEAST = 93                # values that sketches of linked documents share, at least
TINY = 32                 # smallest values compared first
LEAST_TINY = 10           # of them that linked documents share, at least
ORDER_BITS = 17           # of the table of counts that orders values
CHUNK = 2048              # members of a list compared at a time, and
VALUES = 1 << 21          # values of their sets, about
FEW = 12                  # members of a list that is joined with itself
BLOCK = 1 << 20           # values of the sets, and
MEMBERS = 1024            # documents, of one side that are compared at a time
TASK = 1 << 18            # values that a task compares, where pairs are few
SENT = 1_000_000          # values (8 bytes each) of ids sent to all executors at most; more rows are shuffled
ROWS = 1 << 17            # rows of a few numbers that one partition holds; more rows are dealt out


def _least_of(most: int) -> np.ndarray:
    """For each u: of u values of a linked pair's union fewer are shared with a probability under 6e-9."""
    p, law, out = SIMILAR / 100, np.ones(1), np.zeros(most + 1, np.int64)
    for u in range(1, most + 1):
        law = np.r_[law, 0] * (1 - p) + np.r_[0, law] * p          # the binomial law of u values
        out[u] = np.searchsorted(np.cumsum(law), 6e-9)
    return out


LEAST_OF = _least_of(2 * SKETCH)


def shingle_sets(col):
    """The sorted distinct shingle hashes (63 bits) of each row."""
    _, off = column_bytes(col)
    for i, j in row_slices(off, 1 << 20):
        w = Words(col.slice(i, j - i), SPACED)
        g = grams(w.hash, SHINGLE) >> np.uint64(1)          # sorts alike as a signed number
        for a, z in zip(w.row[:-1].tolist(), w.row[1:].tolist()):
            if z - a >= SHINGLE:
                yield np.unique(g[a:z - SHINGLE + 1])
            elif z > a:
                yield grams(w.hash[a:z], z - a, salt=99) >> np.uint64(1)
            else:
                yield np.empty(0, np.uint64)


def _lists(arrays) -> pa.ListArray:
    sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays).view(np.int64) if len(arrays) else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))


LONGS = T.ArrayType(T.LongType(), False)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, c1, c2 (equal for equal sets only, in 128 bits) and sketch."""
    source = docs.select("doc_id", "text")
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()),
                           T.StructField("sketch", LONGS)])

    def run(batches):
        for batch in batches:
            n, c1, c2, kept = [], [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                c1.append(mix(s).sum(dtype=np.uint64))
                c2.append(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64))
                kept.append(s[:SKETCH].copy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(c1, np.uint64).view(np.int64)),
                 pa.array(np.array(c2, np.uint64).view(np.int64)), _lists(kept)], schema.names)

    return map_arrow(source, run, schema)


def value_counts(classes: DataFrame) -> np.ndarray:
    """How many sketches hold a value, by the low bits of its hash: a table of fixed size."""
    mask = np.uint64((1 << ORDER_BITS) - 1)

    def run(batches):
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            v = batch.column(0).flatten().to_numpy().view(np.uint64)
            counts += np.bincount((v & mask).astype(np.int64), minlength=1 << ORDER_BITS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["b", "n"])

    found = map_arrow(classes.select("sketch"), run, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    table_ = found.toPandas()                 # 2 ** ORDER_BITS rows at most
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[table_["b"].to_numpy()] = table_["n"].to_numpy()
    return out


def posted(n: np.ndarray) -> np.ndarray:
    """Number of values that a document with n shingles posts."""
    return np.minimum(n, SKETCH) - np.minimum(LEAST, -(-n * SIMILAR // 100)) + 1


def posted_values(v: np.ndarray, n: int, counts: np.ndarray) -> np.ndarray:
    """The values that a document with sketch ``v`` of ``n`` shingles posts, the rarest first."""
    seen = counts[(v & np.uint64((1 << ORDER_BITS) - 1)).astype(np.int64)]
    return v[np.lexsort((v, seen))[:int(posted(np.int64(n)))]]


def postings(classes: DataFrame, counts) -> DataFrame:
    """value, id, n: the inverted lists. ``counts``: :func:`value_counts`, sent to the executors."""
    def run(batches):
        for batch in batches:
            ids, n = batch.column(0), batch.column(1).to_numpy()
            flat = batch.column(2)
            off = np.asarray(flat.offsets)
            v = flat.values.to_numpy(zero_copy_only=False).view(np.uint64)
            values = [posted_values(v[a:z], k, counts.value)
                      for a, z, k in zip(off[:-1].tolist(), off[1:].tolist(), n.tolist())]
            of = np.repeat(np.arange(len(n)), posted(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)),
                 ids.take(pa.array(of)), pa.array(n[of])], ["value", "id", "n"])

    return map_arrow(classes.select("id", "n", "sketch"), run, "value bigint, id bigint, n bigint")


def similar_sizes(a, b):
    return (100 * F.least(a, b) >= SIMILAR * F.greatest(a, b))


def only(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a match in ``ids``: its size decides whether ``df`` has to be shuffled."""
    return df.join(F.broadcast(ids) if ids.count() * len(ids.columns) <= SENT else ids, on, "left_semi")


def together(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows of a few numbers: up to ``ROWS`` in one partition, and so without further
    shuffles, since dealing them out takes longer than the work on them. More rows stay as they are."""
    return df.repartition(1) if rows <= ROWS else df


def sent(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, for a join: what is joined with it has to be shuffled only for many."""
    return F.broadcast(df) if rows * len(df.columns) <= SENT else df


def both_ways(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Each pair (a, b) and its reverse, with columns of the names ``a`` and ``b``."""
    return pairs.select(F.inline(F.array(F.struct(F.col("a").alias(a), F.col("b").alias(b)),
                                         F.struct(F.col("b").alias(a), F.col("a").alias(b)))))


def full_sets(docs: DataFrame, active: DataFrame) -> DataFrame:
    """id, set of the active documents whose sketch is not the whole set."""
    need = active.where(F.col("n") > SKETCH).select(F.col("id").alias("doc_id"))
    texts = only(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), need, "doc_id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("set", LONGS)])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(list(shingle_sets(batch.column(1))))],
                                             ["id", "set"])

    return map_arrow(texts, run, schema)


def shared_of_union(x, y, k: int):
    """How many of the ``k`` smallest values of two bottom-k sketches' union are in both."""
    union = F.slice(F.sort_array(F.array_union(x, y)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(x, y), union)).cast("long")


def in_groups(pairs: DataFrame, members: DataFrame, sizes: DataFrame, compare, schema: str) -> DataFrame:
    """``compare`` of pairs (a, b) and the rows of ``members`` (by id) that they name, group by group.

    ``sizes``: id, k (values). Pairs go where the smallest neighbour of their ``a`` says, so the
    members of a family meet in one group, or in blocks of at most ``BLOCK`` values and ``MEMBERS``
    documents against each other; a member moves once to each group that holds a pair of it.
    """
    rows = pairs.count()
    pairs = together(pairs.select("a", "b"), rows)
    near = together(both_ways(pairs, "id", "o"), 2 * rows).groupBy(F.col("id").alias("a")).agg(F.min("o").alias("o")).select(
        "a", F.least("a", "o").alias("key"))
    keyed = written(pairs.join(near, "a"), "keyed")
    ids = together(keyed.select("key", F.explode(F.array("a", "b")).alias("id")), 2 * rows).distinct()
    of_key = together(sent(ids, 2 * rows).join(sizes, "id"), 2 * rows).groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("k") / BLOCK)).alias("parts"),
        F.sum("k").alias("k"), F.count("*").alias("m"))
    of_key = written(of_key, "keys")
    total = of_key.agg(F.sum("k"), F.sum("m"), F.max("parts")).first()
    tasks = max(1, -(-int(total[0] or 0) // TASK), -(-int(total[1] or 0) // (8 * MEMBERS)))
    large = F.col("parts") > 1
    place = ["large", "place", "i", "j"]
    at = written(together(keyed, rows).join(together(of_key, rows), "key").select(
        large.alias("large"), F.when(large, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(tasks))).alias("place"),
        F.pmod(F.xxhash64("a"), F.col("parts")).alias("i"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("j"), "a", "b"),
        "grouped-pairs")
    drop_written(keyed)
    drop_written(of_key)
    to = [F.col(c).alias(f"to_{c}") for c in place]
    moved = together(at.select(*to, F.explode(F.array("a", "b")).alias("id")), 2 * rows).distinct()
    moved = sent(moved, 2 * rows).join(members, "id")
    ship(pairs.sparkSession)

    def run(p: pa.Table, m: pa.Table) -> pa.Table:
        found = compare(p, m)
        release_memory()
        return found

    out = at.groupBy(*place).cogroup(moved.groupBy(*[f"to_{c}" for c in place])).applyInArrow(run, schema)
    if (total[2] or 0) <= 1:                               # as many groups as ``tasks``: no more partitions than that need
        out = out.coalesce(2 * tasks)
    out = written(out, "compared")
    drop_written(at)
    release_driver_memory(pairs.sparkSession)
    return out


def shared_counts(v: np.ndarray, starts: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many values each of ``rows`` of the lists (row i: v[starts[i]:starts[i + 1]], distinct) shares with each
    of ``others``: by products of membership matrices, or value by value where these would be nearly empty."""
    def flat(some):
        size = starts[some + 1] - starts[some]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(starts[some] - (end - size), size)
        return v[at], np.repeat(np.arange(len(some)), size)

    x, of_x = flat(rows)
    y, of_y = flat(others)
    both = np.intersect1d(x, y)
    out = np.zeros((len(rows), len(others)), np.float32)
    if not len(both):
        return out.astype(np.int32)

    def columns(values, of):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        on = both[at] == values
        return at[on], of[on]

    (x, of_x), (y, of_y) = columns(x, of_x), columns(y, of_y)
    if len(both) * len(others) > 20 * len(y):
        mark = np.zeros(len(both), bool)
        for i, (lo, hi) in enumerate(np.searchsorted(of_x, [np.arange(len(rows)), np.arange(1, len(rows) + 1)]).T.tolist()):
            mark[x[lo:hi]] = True
            out[i] = np.bincount(of_y[mark[y]], minlength=len(others))
            mark[x[lo:hi]] = False
        return out.astype(np.int32)
    step = max(1, (4 << 20) // (len(rows) + len(others)))
    for lo in range(0, len(both), step):
        width = min(step, len(both) - lo)
        m, k = np.zeros((len(rows), width), np.float32), np.zeros((len(others), width), np.float32)
        on = (x >= lo) & (x < lo + step)
        m[of_x[on], x[on] - lo] = 1
        on = (y >= lo) & (y < lo + step)
        k[of_y[on], y[on] - lo] = 1
        out += m @ k.T                                     # whole numbers up to 2 ** 24 stay exact
    return out.astype(np.int32)


def _similar_pairs(pairs: pa.Table, members: pa.Table, exact: bool) -> pa.Table:
    """The pairs whose ``members`` (id, n, v) pass: sketches, or full sets (``exact``)."""
    ids = members["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    lists = members["v"].combine_chunks()
    v = lists.flatten().to_numpy()
    starts = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    n = np.diff(starts) if exact else members["n"].to_numpy()
    a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    by_a = np.argsort(a, kind="stable")
    a, b, ids = a[by_a], b[by_a], ids[order]
    if exact:
        first, second = np.unique(a), np.unique(b)
        cells = len(first) * len(second)
        if 1024 <= len(a) <= 1 << 23 and cells <= min(8 * len(a), 1 << 24) and (np.diff(ids) > 0).all():     # many against many
            at = [order[np.minimum(np.searchsorted(ids, x), len(ids) - 1)] for x in (first, second)]
            i, j = np.searchsorted(first, a), np.searchsorted(second, b)
            here = (np.isin(a, ids) & np.isin(b, ids))
            s = shared_counts(v, starts, *at)[i, j].astype(np.int64)
            ok = here & (100 * s >= SIMILAR * (n[at[0]][i] + n[at[1]][j] - s)) & (s > 0)
            return pa.table({"a": a[ok], "b": b[ok]})
    found, is_whole = np.zeros(len(a), bool), np.zeros(len(a), bool)
    cuts = np.r_[0, np.flatnonzero(np.diff(a)) + 1, len(a)].tolist()
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        # An id of several texts has several sets.
        first, last = np.searchsorted(ids, b[lo:hi], "left"), np.searchsorted(ids, b[lo:hi], "right")
        of = np.repeat(np.arange(hi - lo), last - first)
        at = order[np.arange(len(of)) + np.repeat(first - np.r_[0, np.cumsum(last - first)[:-1]], last - first)]
        if not len(at):
            continue
        others = [v[starts[j]:starts[j + 1]] for j in at.tolist()]
        for i in order[np.searchsorted(ids, a[lo], "left"):np.searchsorted(ids, a[lo], "right")].tolist():
            one = v[starts[i]:starts[i + 1]]
            s = _shared_of_union(one, others, np.inf)
            whole = exact | ((n[at] <= SKETCH) & (n[i] <= SKETCH))
            ok = 100 * s >= SIMILAR * (n[at] + n[i] - s)
            part = np.flatnonzero(~whole)
            if len(part):
                ok[part] = _shared_of_union(one, [others[j] for j in part.tolist()]) >= LEAST
            found[lo + of[ok]] = True
            is_whole[lo + of[ok & whole]] = True
    out = {"a": a[found], "b": b[found]}
    return pa.table(out if exact else out | {"whole": is_whole[found]})


def links(pairs: DataFrame, active: DataFrame, sets) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; written to the shared folder.

    ``sets``: id, set of documents whose sketch is not the whole set, or what gives them for some of ``active``.
    """
    def ends(p: DataFrame, rows: int) -> DataFrame:
        return written(together(p.select(F.explode(F.array("a", "b")).alias("id")), 2 * rows).distinct(), "ends")

    def similar(shared):
        return 100 * shared >= SIMILAR * (F.col("na") + F.col("nb") - shared)

    pairs = written(pairs.select("a", "b"), "candidates")      # what found them goes before sketches move again
    few = active.select("id", "n", F.slice("sketch", 1, TINY).alias("s"))
    tiny = pairs.join(few.toDF("a", "na", "sa"), "a").join(few.toDF("b", "nb", "sb"), "b")
    whole = (F.col("na") <= SKETCH) & (F.col("nb") <= SKETCH)
    # Of whole sets nothing linked goes: all that they do not share may be in the TINY smallest.
    both = F.col("na") + F.col("nb")
    unshared = both - 2 * F.ceil(SIMILAR * both / (100 + SIMILAR))
    passed = F.when((F.col("na") <= TINY) & (F.col("nb") <= TINY), similar(F.size(F.array_intersect("sa", "sb")))
                    ).otherwise(shared_of_union("sa", "sb", TINY) >= F.when(whole, TINY - unshared).otherwise(LEAST_TINY))
    p = written(tiny.where(passed).select("a", "b"), "tiny-pairs")
    drop_written(pairs)
    few, rows = p, p.count()
    ids = ends(p, rows)
    some = only(active, ids, "id").select("id", "n", F.col("sketch").alias("v"))            # few of the sketches move
    p = in_groups(p, some, active.select("id", F.least("n", F.lit(SKETCH)).alias("k")),
                  lambda x, m: _similar_pairs(x, m, False), "a bigint, b bigint, whole boolean")
    drop_written(few)
    drop_written(ids)
    known, rest = p.where("whole").select("a", "b"), p.where("NOT whole").select("a", "b")
    n_rest = rest.count()
    if not n_rest:
        return known
    # A document with a whole sketch beside a longer one: its sketch is its full set.
    ids = ends(rest, n_rest)
    asked = written(together(only(active.select("id", "n"), ids, "id"), 2 * n_rest), "asked")
    short = only(active.where(F.col("n") <= SKETCH), ids, "id")
    every = (sets(asked) if callable(sets) else sets).select("id", F.col("set").alias("v")).union(
        short.select("id", F.col("sketch").alias("v")))
    exact = in_groups(rest, every, active.select("id", F.col("n").alias("k")),
                      lambda x, m: _similar_pairs(x, m, True), "a bigint, b bigint")
    found = written(together(known.union(exact), rows), "links")
    for done in (p, exact, ids, asked):
        drop_written(done)
    return found


def components(edges: DataFrame, rows: int) -> DataFrame:
    """id, component (smallest id) of every id in ``edges`` (a, b), at most ``rows`` of them."""
    def one(df: DataFrame) -> DataFrame:
        return together(df, 2 * rows)

    both = written(one(both_ways(edges, "a", "b")).distinct(), "edges")
    label = written(one(both).groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component"),
                                                                  F.lit(True).alias("changed")), "components")
    while True:
        # The smallest label next to each id, then the label of that label.
        old = one(label)
        near = one(both).join(old.select(F.col("id").alias("b"), F.col("component").alias("c")), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("c").alias("c"))
        new = old.join(near, "id").select("id", F.least("component", "c").alias("up"), "component")
        far = old.select(F.col("id").alias("up"), F.col("component").alias("c"))
        up = F.least("up", F.coalesce("c", "up"))
        new = written(new.join(far, "up", "left").select(
            "id", up.alias("component"), (F.col("component") != up).alias("changed")), "components")
        drop_written(label)
        label = new
        if not label.where("changed").limit(1).count():
            drop_written(both)
            return label.select("id", "component")


def joined(label: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``label`` (id, component) after the links ``edges`` (a, b) join components of it."""
    rows = edges.count()
    if label is None:
        return components(edges, rows)
    old = together(label, label.count())
    of = lambda x: old.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
    ends = together(edges, rows).join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()
    merged = components(ends, rows)
    new = together(merged, 2 * rows)
    up = new.select(F.col("id").alias("component"), F.col("component").alias("up"))
    known = old.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component"))
    out = written(known.unionByName(new.join(old.select("id"), "id", "left_anti")), "labels")
    drop_written(merged)
    drop_written(label)
    return out


def _labelled(lists: DataFrame, label: DataFrame) -> DataFrame:
    return written(lists.join(sent(label, label.count()), "id", "left").withColumn(
        "label", F.coalesce("component", "id")).drop("component"), "labelled")


def star_pairs(lists: DataFrame, order) -> DataFrame:
    """a, b: each member of a list with the list's first by ``order``, where components differ."""
    first = lists.groupBy("value").agg(F.min(F.struct(order.alias("o"), "id", "n", "label")).alias("p"),
                                       F.count("*").alias("m")).where("m > 1").select("value", "p")
    pairs = lists.join(first, "value").where((F.col("id") != F.col("p.id")) & (F.col("label") != F.col("p.label"))
                                             & similar_sizes(F.col("n"), F.col("p.n")))
    return pairs.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()


def remaining_pairs(lists: DataFrame, active: DataFrame, counts, sets=None) -> DataFrame:
    """a, b: pairs of a list's members in different components whose sketches overlap enough.

    ``sets`` as for :func:`links`. With it, many pairs of long lists are compared by their full sets first."""
    by_label = lists.groupBy("value", "label").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("id")).alias("sig"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("sig2"),
        F.min("id").alias("first"), F.max("id").alias("last"))
    stats = by_label.groupBy("value").agg(F.count("*").alias("labels"), F.sum("k").alias("m"),
                                          F.bit_xor("sig").alias("sig"), F.bit_xor("sig2").alias("sig2"),
                                          F.min("first").alias("first"), F.max("last").alias("last"),
                                          F.max("k").alias("most"))
    # Lists of the same members are compared once.
    stats = written(stats.where("labels > 1").groupBy("m", "sig", "sig2", "first", "last").agg(
        F.min(F.struct("value", "most")).alias("v")).select(
        F.col("v.value").alias("value"), "m", (F.col("m") - F.col("v.most")).alias("others")), "open-lists")
    d = written(lists.join(sent(stats, stats.count()), "value"), "open-members")
    few = d.where(F.col("m") <= FEW).select("value", "id", "n", "label")
    other = few.select("value", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    pairs = few.join(other, "value").where((F.col("id") < F.col("id2")) & (F.col("label") != F.col("label2"))
                                           & similar_sizes(F.col("n"), F.col("n2")))
    pairs = pairs.select(F.col("id").alias("a"), F.col("id2").alias("b"))
    near = near_members(d.where(F.col("m") > FEW), active, counts)
    if near is None:
        return pairs.distinct()
    far = near
    if sets is not None and (near.agg(F.sum(F.size("b"))).first()[0] or 0) > ROWS:
        far = near.where("whole")
        pairs = pairs.union(near_links(near.where("NOT whole"), active, sets))
    far = far.select("a", F.explode("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.union(far).distinct()


def merged(d: DataFrame) -> DataFrame:
    """key, id, n, label: the members of the lists ``d`` (value, id, n, label, m, others), those with a common member
    as one list where that gives fewer comparisons. ``key``: the smallest value of the lists."""
    of_id = d.groupBy("id").agg(F.count("*").alias("k"))
    leader = d.join(of_id, "id").groupBy("value").agg(
        F.max(F.struct("k", "id")).getField("id").alias("leader"), F.first(F.col("m") * F.col("others")).alias("apart"))
    leader = leader.withColumn("key", F.min("value").over(Window.partitionBy("leader")))
    leader = written(leader.select("value", "key", "apart"), "list-keys")
    rows = leader.count()
    union = d.join(sent(leader, rows), "value").select("key", "id", "label").distinct()
    size = union.groupBy("key", "label").agg(F.count("*").alias("k")).groupBy("key").agg(
        (F.sum("k") * (F.sum("k") - F.max("k"))).alias("work"))
    apart = leader.groupBy("key").agg(F.sum("apart").alias("apart"))
    one = size.join(apart, "key").where("work <= apart").select("key", F.lit(True).alias("one"))
    to = written(leader.join(one, "key", "left").select(
        "value", F.when(F.col("one"), F.col("key")).otherwise(F.col("value")).alias("key")), "list-keys")
    drop_written(leader)
    out = written(d.join(sent(to, rows), "value").select("key", "id", "n", "label").distinct(), "long-members")
    drop_written(to)
    return out


def near_members(d: DataFrame, active: DataFrame, counts) -> DataFrame | None:
    """key, block, chunk, a, b, whole: for a member ``a`` of the long lists ``d`` the members ``b`` in other components
    whose sketches overlap enough; ``whole`` where that is the exact overlap (of a component one). Where a and b meet:
    every member stands in one chunk of its list, and members outside the largest component also in one block of those;
    a task compares a block with a chunk. Written to the shared folder; None without long lists."""
    rows = d.count()
    if not rows:
        return None
    d = merged(together(d, rows))
    stats = d.groupBy("key", "label").agg(F.count("*").alias("k"), F.sum("n").alias("v")).groupBy("key").agg(
        F.max(F.struct("k", "label", "v")).alias("top"), F.sum("k").alias("m"), F.sum("v").alias("v"))
    parts = lambda k, v: F.greatest(F.ceil(k / CHUNK), F.ceil(v / VALUES), F.lit(1)).cast("int")
    stats = stats.select("key", F.col("top.label").alias("most"), parts(F.col("m"), F.col("v")).alias("chunks"),
                         parts(F.col("m") - F.col("top.k"), F.col("v") - F.col("top.v")).alias("blocks"))
    stats = written(together(stats, rows), "long-lists")
    at = together(d, rows).join(sent(stats, stats.count()), "key").withColumn("out", F.col("label") != F.col("most"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    asked = at.select("key", "id", "n", "label", "out", F.lit(False).alias("loose"), chunk.alias("chunk"),
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    loose = at.where("out").select("key", "id", "n", "label", "out", F.lit(True).alias("loose"),
                                   F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), block.alias("block"))
    ids = written(together(d.select("id"), rows).distinct(), "open-ids")
    some = only(active.select("id", "sketch"), ids, "id")
    ship(d.sparkSession)

    def compare(group: pa.Table) -> pa.Table:
        found = _compare(group, counts.value)
        release_memory()
        return found

    out = written(asked.unionByName(loose).join(some, "id").groupBy("key", "block", "chunk").applyInArrow(
        compare, "key bigint, block int, chunk int, a bigint, b array<bigint>, whole boolean"), "near-members")
    for done in (d, stats, ids):
        drop_written(done)
    return out


def near_links(near: DataFrame, active: DataFrame, sets) -> DataFrame:
    """a, b: the pairs of the rows ``near`` of :func:`near_members` whose full sets are similar; they are compared where
    they were found. Written to the shared folder."""
    place = ["key", "block", "chunk"]
    to = [F.col(c).alias(f"to_{c}") for c in place]
    moved = written(near.select(*to, F.explode(F.concat(F.array("a"), "b")).alias("id")).distinct(), "moved")
    ids = written(moved.select("id").distinct(), "ends")
    asked = written(only(active.select("id", "n"), ids, "id"), "asked")
    short = only(active.where(F.col("n") <= SKETCH), ids, "id")
    every = sets(asked).select("id", F.col("set").alias("v")).union(short.select("id", F.col("sketch").alias("v")))
    ship(near.sparkSession)

    def run(p: pa.Table, m: pa.Table) -> pa.Table:
        rows = pa.table({"a": np.repeat(p["a"].to_numpy(), pc.list_value_length(p["b"]).to_numpy()),
                         "b": pc.list_flatten(p["b"])})
        found = _similar_pairs(rows, m, True)
        release_memory()
        return found

    found = written(near.select(*place, "a", "b").groupBy(*place).cogroup(moved.join(every, "id").groupBy(
        *[f"to_{c}" for c in place])).applyInArrow(run, "a bigint, b bigint"), "near-links")
    for done in (moved, ids, asked):
        drop_written(done)
    release_driver_memory(near.sparkSession)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _shared_of_union(one: np.ndarray, others: list[np.ndarray], k: float = SKETCH) -> np.ndarray:
    """As :func:`shared_of_union`, of a sketch with each of some others."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    of = np.repeat(np.arange(len(others)), sizes)
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = one[at] == flat
    before = np.cumsum(both) - both                          # shared values before each one, over all
    rank = at + (np.arange(len(flat)) - begin[of]) - (before - before[begin][of])
    return np.bincount(of[both & (rank < k)], minlength=len(others))


def _compare(group: pa.Table, counts: np.ndarray) -> pa.Table:
    """For each loose member the members of the chunk that may be linked and share no posted
    value before the list's first one with it."""
    place = [group[c][0].as_py() for c in ("key", "block", "chunk")]
    ids, n, label, out = (group[c].to_numpy() for c in ("id", "n", "label", "out"))
    is_loose = group["loose"].to_numpy()
    loose, asked = np.flatnonzero(is_loose), np.flatnonzero(~is_loose)
    lists = group["sketch"].combine_chunks()
    v = lists.flatten().to_numpy()
    starts = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
    posts = []                                                  # posted values before the list's first
    for a, z, k in zip(starts[:-1].tolist(), starts[1:].tolist(), n.tolist()):
        p = posted_values(v[a:z].view(np.uint64), k, counts).view(np.int64)
        posts.append(np.sort(p[p < place[0]]))
    before = np.r_[0, np.cumsum([len(p) for p in posts])]
    posts = np.concatenate([*posts, np.empty(0, np.int64)])
    # A sketch tells of all values up to its largest, a whole set of all.
    upto = np.where(n <= SKETCH, np.iinfo(np.int64).max, v[np.maximum(starts[1:] - 1, 0)] if len(v) else 0)
    within = np.empty((len(asked), CHUNK), np.int32)
    found = {"a": [], "b": [], "whole": []}
    for lo in range(0, len(loose), CHUNK):                      # about one turn: chunks are even by hash only
        some = loose[lo:lo + CHUNK]
        shared = shared_counts(v, starts, some, asked)
        earlier = shared_counts(posts, before, some, asked) > 0
        for j, r in enumerate(asked.tolist()):
            within[j, :len(some)] = np.searchsorted(v[starts[r]:starts[r + 1]], upto[some], "right")
        for i, r in enumerate(some.tolist()):
            s = shared[i].astype(np.int64)
            u = within[:, i] + np.searchsorted(v[starts[r]:starts[r + 1]], upto[asked], "right") - s
            whole = (n[asked] <= SKETCH) & (n[r] <= SKETCH)
            ok = np.where(whole, 100 * s >= SIMILAR * u, s >= LEAST_OF[np.minimum(u, 2 * SKETCH)])
            ok &= (100 * np.minimum(n[asked], n[r]) >= SIMILAR * np.maximum(n[asked], n[r])) & ~earlier[i]
            # Two loose members meet twice.
            ok &= (label[asked] != label[r]) & (~out[asked] | (ids[asked] > ids[r]))
            exact = np.flatnonzero(ok & whole)
            _, one = np.unique(label[asked][exact], return_index=True)      # one exact link joins two components
            for at, is_whole in ((exact[one], True), (np.flatnonzero(ok & ~whole), False)):
                if len(at):
                    found["a"].append(ids[r])
                    found["b"].append(ids[asked[at]])
                    found["whole"].append(is_whole)
    same = {c: pa.array([x] * len(found["a"]), k) for c, x, k in zip(("key", "block", "chunk"), place, (pa.int64(), pa.int32(), pa.int32()))}
    return pa.table(same | {"a": pa.array(found["a"], pa.int64()), "b": _lists(found["b"]), "whole": pa.array(found["whole"], pa.bool_())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text)."""
    with shuffles_dropped(docs.sparkSession):
        return _near_duplicates(docs)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wide = written(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    own = written(wide.drop("sketch", "row"), "sets")
    known = wide.where("n_shingles > 0 AND doc_id IS NOT NULL").drop("sketch")
    classes = written(known.groupBy("n_shingles", "c1", "c2").agg(
        F.min("doc_id").alias("id"), F.min_by("row", "doc_id").alias("row")), "classes")
    first = only(wide, classes.select("row"), "row").select(
        "row", F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    counts = docs.sparkSession.sparkContext.broadcast(value_counts(first))
    of_value = Window.partitionBy("value")                 # one shuffle tells and keeps the lists of several
    lists = written(postings(first, counts).withColumns(
        {"lo": F.min("id").over(of_value), "hi": F.max("id").over(of_value)}).where("lo < hi").select(
        "value", "id", "n").distinct(), "lists")
    # One text for each id, by its row: no sketch has to move for that.
    one = classes.groupBy("id").agg(F.min("row").alias("row"))
    active = written(only(first, lists.select("id").distinct().join(one, "id").select("row"), "row").drop("row"), "active")
    drop_written(wide)
    release_driver_memory(docs.sparkSession)

    def sets(some: DataFrame) -> DataFrame:
        return full_sets(docs, some)

    label = None
    for round_ in ("id", "hash", "rest"):
        labelled = lists.withColumn("label", F.col("id")) if label is None else _labelled(lists, label)
        if round_ == "rest":
            pairs = remaining_pairs(labelled, active, counts, sets)
        else:
            pairs = star_pairs(labelled, F.col("id") if round_ == "id" else F.xxhash64("id"))
        found = links(pairs, active, sets)
        before, label = label, joined(label, found)
        drop_written(found)
        if before is not None:
            drop_written(labelled)
        release_driver_memory(docs.sparkSession)           # after dozens of short jobs
    for done in (lists, active):
        drop_written(done)
    component = label
    member = classes.join(component, "id", "left").select(
        F.col("n_shingles").alias("_n"), F.col("c1").alias("_c1"), F.col("c2").alias("_c2"),
        F.coalesce("component", "id").alias("_component"))
    out = own.join(member, (F.col("n_shingles") == F.col("_n")) & (F.col("c1") == F.col("_c1"))
                   & (F.col("c2") == F.col("_c2")), "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"),
                      F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP8_SQL = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM lowered WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s >= 75 * (x.n + y.n - s)
),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
low AS (SELECT a AS doc_id, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
       doc_id = coalesce(component, doc_id) AS kept
FROM lowered LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)"""
