"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Each source gets a target of words: its weight's share of all words, but never more than
   ``max_epochs`` times what it has; what is over goes to the others by weight.
2. A source is a permuted row of blocks (a block: the documents whose id hashes into one of
   equal intervals). It is read from the first block on, again from the start for a further
   epoch, until its target of words is met: whole blocks, one last cut block, one last cut
   document. The blocks it draws are its quota.
3. The root of a binary tree holds the quotas of all sources and a number of output shards.
   Each node splits its shards in two halves and draws, source by source, how many of its
   blocks go left: the exact multivariate hypergeometric law of a random deal. A leaf is a
   shard with an exact quota of each source.
4. A shard takes its quota as the next disjoint run of each source's permuted draws, and
   orders its documents by a hash: the local shuffle.

All of it is DataFrame expressions. Every table but the documents has a row per (source,
block) or per (shard, source); a source with a third of all words has its third of the
blocks. Draws use hashes of ``seed`` and names, so reruns agree.

Null text: size 0, never taken. A null source is a source of its own, last in order. A null
id hashes as empty text. Repeated rows are documents of their own. Sources without words
have target 0. Documents of equal hash are in order of id and size. Very long texts are one
document of a block; a text is cut only where its source's target ends. Only doc_id, source and text
are read, so other columns can't clash. Empty input gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_WORD, drop_written, release_driver_memory, table, written

WEIGHTS = (1, 2, 3)        # of the sources in order, repeating
MAX_EPOCHS = 3
BLOCK_WORDS = 100_000      # words of a block, about
SHARD_BLOCKS = 64          # blocks of a shard, about
GROUP = 1024               # blocks whose words are summed in one window


def target_words(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> weight and target of each source.

    The level at which the targets stop is found by ordering the sources by the level that
    fills them: those below the level are full, the rest share what is left by weight. One
    row per source is ordered here (sources are a configuration, not data).
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    place = F.row_number().over(order) - 1
    d = sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place % n).cast("double"))
    full = max_epochs * F.col("source_size").cast("double")
    d = d.withColumn("_full", full).withColumn("_fills", F.col("_full") / F.col("weight"))
    by_level = W.orderBy("_fills", F.col("source").asc_nulls_last())
    below = by_level.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    d = (d.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
         .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_full").over(below), F.lit(0.0)))
         .withColumn("_w", F.sum("weight").over(everything)
                     - F.coalesce(F.sum("weight").over(below), F.lit(0.0))))
    # The first source in this order that its share does not fill sets the level for the rest.
    d = d.withColumn("_level", F.min(F.when(F.col("_left") < F.col("_fills") * F.col("_w"),
                                            F.struct("_fills", (F.col("_left") / F.col("_w")).alias("l")))
                                     ).over(everything)["l"])
    target = F.when(F.col("_level").isNull(), F.col("_full")).otherwise(
        F.least(F.col("_full"), F.col("_level") * F.col("weight")))
    return d.select("source", "source_size", "weight", target.alias("target"))


def _fraction(*parts) -> Column:
    """A number in (0, 1) from the md5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def hypergeometric(total, kind, drawn, u: str) -> str:
    """SQL of how many of ``drawn`` items taken from ``total`` are of a kind with ``kind`` items.

    Inverse of the distribution function at ``u``: one fold sums the probabilities relative to
    their start, the next stops at u's share of the sum. Values over 12 standard deviations
    from the mean, whose probability is below double precision, are not visited.
    """
    n, k, m = f"({total})", f"({kind})", f"({drawn})"
    mean = f"({m} * ({k} / greatest({n}, 1D)))"
    spread = f"(12 * sqrt({mean} * (1 - {k} / greatest({n}, 1D)) + 1) + 20)"
    lo = f"cast(greatest(0, {m} - ({n} - {k}), floor({mean} - {spread})) as int)"
    hi = f"cast(least({k}, {m}, ceil({mean} + {spread})) as int)"
    # log of p(x + 1) / p(x)
    step = (f"ln(({k} - x) * cast({m} - x as double) / ((x + 1D) * ({n} - {k} - {m} + x + 1D)))")
    values = f"sequence({lo}, {hi})"
    peak = (f"aggregate(slice({values}, 1, {hi} - {lo}), named_struct('l', 0D, 'top', 0D), (z, x) -> "
            f"named_struct('l', z.l + {step}, 'top', greatest(z.top, z.l + {step})), z -> z.top)")
    # cumulative sums of exp(log p(x) - top), x = lo .. hi
    fold = (f"aggregate({values}, named_struct('l', 0D, 'c', 0D, 'x', {lo}, 'done', false), "
            f"(z, x) -> named_struct("
            f"'l', if(x < {hi}, z.l + {step}, z.l), "
            f"'c', z.c + exp(z.l - top), "
            f"'x', if(z.done, z.x, x), "
            f"'done', z.done or z.c + exp(z.l - top) >= GOAL), ")
    sized = fold.replace("GOAL", "double('Infinity')") + "z -> z.c)"
    return (f"transform(array({peak}), top -> transform(array(({u}) * {sized}), goal -> "
            f"{fold.replace('GOAL', 'goal')} z -> z.x))[0])[0]")


def _split(node: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: each node of several shards becomes its two halves."""
    name = "concat_ws('/', '{}', first, shards, cast(i as string))".format(seed)
    u = f"(cast(conv(substring(md5({name}), 1, 12), 16, 10) as double) + 0.5) / {float(1 << 48)!r}"
    deal = hypergeometric("s.n", "q", "s.m", u)
    left = (f"aggregate(sequence(0, size(quota) - 1), named_struct('n', total, 'm', take, "
            f"'out', cast(array() as array<bigint>)), (s, i) -> "
            f"transform(array(quota[i]), q -> transform(array(cast({deal} as bigint)), d -> "
            f"named_struct('n', s.n - q, 'm', s.m - d, 'out', concat(s.out, array(d))))[0])[0], s -> s.out)")
    d = (node.withColumn("total", F.expr("aggregate(quota, 0L, (a, b) -> a + b)"))
         .withColumn("half", F.expr("cast(floor(shards / 2) as bigint)"))
         .withColumn("take", F.expr("cast(round(total * (half / shards)) as bigint)"))
         .withColumn("left", F.when(F.col("shards") > 1, F.expr(left))))
    both = F.when(F.col("shards") > 1, F.array(
        F.struct("first", F.col("half").alias("shards"), F.col("left").alias("quota")),
        F.struct((F.col("first") + F.col("half")).alias("first"),
                 (F.col("shards") - F.col("half")).alias("shards"),
                 F.expr("zip_with(quota, left, (a, b) -> a - b)").alias("quota")),
    )).otherwise(F.array(F.struct("first", "shards", "quota")))
    return d.select(F.explode(both).alias("n")).select("n.*")


def splitting_tree(quotas: DataFrame, seed: int = 0, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(src, quota) -> (src, shard, run, from): shard takes draws from .. from + run - 1 of src.

    The depth of the tree is the logarithm of the number of shards; ``total`` blocks make
    one shard for ``shard_blocks`` of them.
    """
    root = quotas.agg(
        F.array_sort(F.collect_list(F.struct("src", "quota"))).alias("q"),
        F.coalesce(F.sum("quota"), F.lit(0)).alias("blocks"))
    blocks = root.first()["blocks"]
    shards = min(max(1, round(blocks / shard_blocks)), max(1, blocks))
    node = root.select(F.lit(0).cast("bigint").alias("first"), F.lit(shards).cast("bigint").alias("shards"),
                       F.col("q.quota").alias("quota"))
    depth = (shards - 1).bit_length()
    for level in range(depth):
        node = _split(node, seed)
        if level % 4 == 3:                 # keeps the plan short; a row per node
            node = written(node.repartition("first"), "mix-tree")
    leaf = node.select(F.col("first").alias("shard"), F.posexplode("quota").alias("i", "run"))
    named = root.select(F.posexplode("q").alias("i", "s")).select("i", F.col("s.src").alias("src"))
    return (leaf.join(named, "i").where("run > 0").select("src", "shard", "run")
            .withColumn("from", F.sum("run").over(W.partitionBy("src").orderBy("shard")) - F.col("run")))


def plan_mix(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
             weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
             shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and ``placed`` of each document.

    ``docs``: doc_id, source, text. ``placed`` lists where the mix puts the document: shard,
    epoch and words (all of the document's, except for the one that a source's target cuts).
    """
    sized = written(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0))
        .cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_h")), "mix-sizes")
    h32 = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    per_source = max(1, min(round(total / block_words), 1 << 30))
    sized = sized.withColumn("block", F.shiftright(h32 * per_source, 32))
    blocks = written(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    src = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    src = target_words(src, weights, max_epochs)
    src = src.withColumn("src", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    goal = F.round("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    src = written(src.withColumn("whole", whole.cast("bigint"))
                  .withColumn("rest", goal - F.col("whole") * F.col("source_size")), "mix-sources")
    # Words before each block: sums of groups of blocks first, then blocks inside their group.
    blocks = blocks.join(src, blocks["source"].eqNullSafe(src["source"])).drop(src["source"])
    blocks = blocks.withColumn("group", F.floor(F.col("block") / GROUP))
    groups = blocks.groupBy("src", "group").agg(F.sum("words").alias("gw"))
    groups = groups.withColumn("gb", F.sum("gw").over(W.partitionBy("src").orderBy("group")) - F.col("gw"))
    inside = W.partitionBy("src", "group").orderBy("block")
    blocks = (blocks.join(groups.drop("gw"), ["src", "group"])
              .withColumn("before", F.col("gb") + F.sum("words").over(inside) - F.col("words"))
              .withColumn("last", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("before"))))
              .drop("gb", "group", "before"))
    blocks = written(blocks, "mix-read-blocks")
    release_driver_memory(docs.sparkSession)
    # Draws of a source: epoch after epoch, its blocks in order of their number.
    drawn = blocks.select(
        "src", "block", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int"))).alias("epoch"),
        "whole", "last").where("epoch < whole OR last > 0").withColumn(
        "draw", F.col("epoch") * F.lit(per_source).cast("bigint") + F.col("block"))
    quota = (drawn.groupBy("src").agg((F.max("draw") + 1).alias("quota")))
    leaves = splitting_tree(quota, seed, shard_blocks)
    shard_of = leaves.select("src", "shard", F.explode(F.expr("sequence(`from`, `from` + run - 1)")).alias("draw"))
    drawn = (drawn.join(shard_of, ["src", "draw"]).groupBy("src", "block")
             .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("draws")))
    dealt = (blocks.join(drawn, ["src", "block"], "left")
             .select(F.col("source").alias("_s"), F.col("block").alias("_b"), "source_size", "target",
                     "whole", F.col("last").alias("_last"), F.col("words").alias("_words"), "draws"))
    docs_in = sized.join(dealt, (F.col("block") == F.col("_b")) & F.col("source").eqNullSafe(F.col("_s")))
    # Documents of the block that the target cuts, in order of their hash.
    cut = (F.col("_last") > 0) & (F.col("_last") < F.col("_words"))
    order = W.partitionBy("source", "block").orderBy("_h", "doc_id", "size")
    before = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1))
    part = F.greatest(F.lit(0), F.least("size", F.col("_last") - F.coalesce(before, F.lit(0))))
    docs_in = docs_in.withColumn("_again", F.when(
        F.col("_last") == 0, F.lit(0)).when(cut, part).otherwise(F.col("size")))
    words = lambda d: F.when(d["epoch"] < F.col("whole"), F.col("size")).otherwise(F.col("_again"))
    placed = F.filter(F.transform("draws", lambda d: F.struct(
        d["shard"].alias("shard"), d["epoch"].alias("epoch"), words(d).alias("words"))),
        lambda p: p["words"] > 0)
    return docs_in.select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce(F.aggregate(placed, F.lit(0).cast("bigint"), lambda a, p: a + p["words"]),
                   F.lit(0).cast("bigint")).alias("taken"),
        F.coalesce(placed, F.expr("cast(array() as array<struct<shard:bigint,epoch:int,words:bigint>>)"))
        .alias("placed"))


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mixed corpus: a row for each document and epoch it is taken in.

    shard, place (order inside the shard), doc_id, source, epoch, n_words and text; the text
    of a document that is cut ends after ``n_words`` words. Rows that share doc_id, source and
    size also share their placements.
    """
    plan = plan_mix(docs, seed, **options).where("taken > 0").select(
        "doc_id", "source", "size", F.explode("placed").alias("p"))
    plan = plan.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"),
                       F.col("p.shard").alias("shard"), F.col("p.epoch").alias("epoch"),
                       F.col("p.words").alias("n_words")).distinct()
    text = docs.select("doc_id", "source", "text", F.regexp_count("text", F.lit(SPACE_WORD)).alias("size"))
    out = text.join(plan, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
                    & (F.col("size") == F.col("_n")))
    head = F.when(F.col("n_words") < F.col("size"), F.array_join(F.slice(F.array_remove(F.split(
        "text", r"[\x20\x09-\x0D]+", -1), ""), F.lit(1), F.col("n_words").cast("int")), " ")).otherwise(F.col("text"))
    place = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("epoch").cast("string"),
                              F.col("doc_id").cast("string")))
    return out.select("shard", place.alias("place"), "doc_id", "source", "epoch", "n_words", head.alias("text"))


def write_shards(mixed: DataFrame, path: str) -> None:
    """Write the output of :func:`mix`, a folder for each shard, shuffled inside it."""
    (mixed.repartition("shard").sortWithinPartitions("shard", "place")
     .write.partitionBy("shard").parquet(path))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the mix takes each document, by the default weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return plan_mix(docs).select("doc_id", "size", "source_size",
                                 F.round("target", 6).alias("target"), "taken")


#: What op1_mixing must give: documents of a source in order of the md5 of
#: their ids are read until its target of words is met.
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, 3.0 * source_size / weight AS fills FROM s),
level AS (
  SELECT max((total - filled) / open_weight) AS l FROM (
    SELECT a.fills, (SELECT sum(source_size) FROM s) AS total,
           coalesce(sum(CASE WHEN b.fills <= a.fills THEN 3.0 * b.source_size END), 0) AS filled,
           sum(CASE WHEN b.fills > a.fills THEN b.weight END) AS open_weight
    FROM (SELECT DISTINCT fills FROM f UNION SELECT -1.0) a, f b GROUP BY a.fills)
  WHERE open_weight > 0 AND filled + fills * open_weight <= total
    AND (total - filled) / open_weight >= fills),
t AS (
  SELECT *, least(3.0 * source_size, (SELECT l FROM level) * weight) AS target FROM f),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM t),
o AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole,
         CAST(round(r.target) AS BIGINT) - r.whole * r.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM o
"""
