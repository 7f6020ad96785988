"""Keep the keys that can matter, before any shuffle: a Bloom filter in plain expressions.

A filter is ``2 ** bits`` bits in 64-bit words. Two bits are set for each wanted key: the words are
grouped and OR-ed with map-side combine, so at most ``2 ** (bits - 6)`` rows are shuffled, however
many keys there are. As one array in a scalar subquery it is computed once and tested in the
scan's generated code. A key that was not wanted passes with a probability of about
``(1 - exp(-2 n / 2 ** bits)) ** 2`` for n wanted keys; none that was is lost. The filter's size is
fixed (1 MB by default, good for about 1 million wanted keys; ``bits`` raises it to 8 MB and
8 million). Beyond that more keys pass, up to all: the result stays the same, only nothing is saved.

Spark's own runtime Bloom filter needs a semi-join, which would shuffle by the key before the
ranking and so take its map-side limit away; here the limit stays below the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 23
MAX_BITS = 26


def _places(key: str, bits: int) -> list[Column]:
    """Two bit numbers of a key; null is a key of its own."""
    mask = (1 << bits) - 1
    return [F.xxhash64(F.col(key)).bitwiseAND(mask), F.xxhash64(F.lit(1), F.col(key)).bitwiseAND(mask)]


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """One row: the filter's words, an array."""
    if not 6 < bits <= MAX_BITS:
        raise ValueError(f"bits must lie in 7..{MAX_BITS}")
    at = keys.select(F.explode(F.array(*_places(key, bits))).alias("at"))
    words = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("word_bits"))
    every = keys.sparkSession.range(1 << bits - 6)
    dense = every.join(words, every["id"] == words["word"], "left").select(
        F.struct("id", F.coalesce("word_bits", F.lit(0).cast("long")).alias("word_bits")).alias("w"))
    return dense.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["word_bits"]).alias("filter"))


def passes(words: Column, key: str, bits: int = BITS) -> Column:
    """Whether both bits of the key are set."""
    out = F.lit(True)
    for at in _places(key, bits):
        out = out & (F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1)
    return out


def maybe_recent(df: DataFrame, key: str, wanted: Column, bits: int = BITS) -> DataFrame:
    """Rows whose key has a row for which ``wanted`` holds, and few others."""
    return df.filter(passes(key_filter(df.filter(wanted), key, bits).scalar(), key, bits))
