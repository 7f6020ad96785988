"""Token counts of a byte-level BPE vocabulary without emitting identifiers.

Each pre-token starts as one symbol per byte. Adjacent pairs wait in a heap by merge rank;
symbols form a linked list. The lowest-ranked pair is popped and merged, its neighbours
give new pairs, until none is left: the count is the initial symbols minus the merges.
Counts of pre-tokens are remembered in each worker, up to a bounded number.

Null text: empty, 0 bytes and 0 tokens. Very long pre-tokens (over 64 KB) are merged in typed
arrays, the places of equal ranks from left to right. An empty table gives an empty result. Repeated rows are counted row by row; further
columns pass through unless they bear a result's name, in which case the result replaces
them.
"""

from __future__ import annotations

import heapq
import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import extended, map_arrow, table

#: The pattern that splits text before byte-level merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 400_000      # pre-tokens whose counts a worker keeps
LONGEST_REMEMBERED = 64   # bytes
LONG = 1 << 16            # bytes of a pre-token that is merged in typed arrays
LISTED = 1 << 20          # code points of a text whose pre-tokens are listed at once


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Bytes with a visible Latin-1 character stand for themselves; the rest take the code
    points from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


SHIFT = 20        # bits of a symbol's number in a pair's key


def load_merges(vocabulary: bytes) -> tuple[dict[int, int], list[str]]:
    """Rank of each mergeable pair, and the special strings, of a tokenizer's JSON file.

    Symbols are numbers: a byte is itself, what the merge of rank r makes is 256 + r. The
    key of a pair is its left number shifted past its right one.
    """
    spec = json.loads(vocabulary)
    number = byte_symbols()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    for rank, (a, b) in enumerate(pairs):
        number.setdefault(a + b, 256 + rank)
    if len(pairs) + 256 >= 1 << SHIFT:
        raise ValueError("the vocabulary has too many merges")
    ranks = {}
    for rank, (a, b) in enumerate(pairs):
        if number[a + b] != 256 + rank:
            raise ValueError("two merges make the same symbol")
        ranks[number[a] << SHIFT | number[b]] = rank
    return ranks, [t["content"] for t in spec["added_tokens"]]


def count_symbols(piece: bytes, ranks: dict[int, int]) -> int:
    """Symbols left of ``piece`` after all merges."""
    n = len(piece)
    if n < 2:
        return n
    if n > LONG:
        return count_long(piece, ranks)
    get = ranks.get
    symbol = list(piece)
    # The rank of the pair that starts at each symbol, -1: none; a heap entry is stale when
    # its rank is no longer the one noted here.
    rank = [get(a << SHIFT | b, -1) for a, b in zip(piece, piece[1:])]
    heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
    if not heap:
        return n
    rank.append(-1)
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    left = n
    while heap:
        top = pop(heap)
        i, r = top & 0xFFFFFFFF, top >> 32
        if rank[i] != r:
            continue
        j = after[i]
        made = symbol[i] = 256 + r
        after[i] = k = after[j]
        rank[j] = -1
        left -= 1
        if k < n:
            before[k] = i
            rank[i] = q = get(made << SHIFT | symbol[k], -1)
            if q >= 0:
                push(heap, q << 32 | i)
        else:
            rank[i] = -1
        h = before[i]
        if h >= 0:
            rank[h] = q = get(symbol[h] << SHIFT | made, -1)
            if q >= 0:
                push(heap, q << 32 | h)
    return left


def count_long(piece: bytes, ranks: dict[int, int]) -> int:
    """As :func:`count_symbols`, in about 24 bytes a symbol.

    The heap holds ranks; the places of a rank's pairs are a typed array beside it. A merge makes
    only pairs of higher rank (they hold the new symbol), so a rank's places are complete when
    it is popped and are merged from left to right.
    """
    n, get = len(piece), ranks.get
    raw = np.frombuffer(piece, np.uint8).astype(np.int32)
    of_pair = np.full((256, 256), -1, np.int32)
    for key, r in ranks.items():
        if key >> SHIFT < 256 and key & (1 << SHIFT) - 1 < 256:
            of_pair[key >> SHIFT, key & (1 << SHIFT) - 1] = r
    first = np.append(of_pair[raw[:-1], raw[1:]], np.int32(-1))
    order = np.argsort(first, kind="stable").astype(np.int32)
    there = first[order]
    cuts = np.flatnonzero(np.r_[True, there[1:] != there[:-1]]).tolist() + [n]
    places = {int(there[a]): array("i", order[a:z].tobytes()) for a, z in zip(cuts, cuts[1:]) if there[a] >= 0}
    symbol, rank = array("i", raw.tobytes()), array("i", first.tobytes())
    before = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
    after = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
    del raw, first, order, there
    heap, left = list(places), n
    heapq.heapify(heap)

    def note(i: int, a: int, b: int) -> None:
        rank[i] = r = get(a << SHIFT | b, -1)
        if r >= 0:
            if r not in places:
                places[r] = array("i")
                heapq.heappush(heap, r)
            places[r].append(i)

    while heap:
        r = heapq.heappop(heap)
        for i in np.unique(np.frombuffer(places.pop(r), np.int32)).tolist():
            if rank[i] != r:
                continue
            j = after[i]
            symbol[i] = 256 + r
            after[i] = k = after[j]
            rank[i] = rank[j] = -1
            left -= 1
            if k < n:
                before[k] = i
                note(i, symbol[i], symbol[k])
            if before[i] >= 0:
                note(before[i], symbol[before[i]], symbol[i])
    return left


class PieceCounts(dict):
    """Token counts of pre-tokens, found when first asked for; bounded."""

    def __init__(self, ranks: dict[int, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        raw = piece.encode()
        n = count_symbols(raw, self.ranks)
        if len(raw) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Token counts of texts under one vocabulary."""

    def __init__(self, vocabulary: bytes):
        import regex
        ranks, special = load_merges(vocabulary)
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(
            special, key=len, reverse=True))) if special else None
        self.count = PieceCounts(ranks).__getitem__

    def text(self, text: str) -> int:
        """Tokens of ``text``; a special string inside it is one token, as by default."""
        total = pos = 0
        for m in self.special.finditer(text) if self.special else ():
            total += self._plain(text[pos:m.start()]) + 1
            pos = m.end()
        return total + self._plain(text[pos:] if pos else text)

    def _plain(self, text: str) -> int:
        if len(text) <= LISTED:
            return sum(map(self.count, self.split.findall(text)))
        return sum(self.count(m[0]) for m in self.split.finditer(text))


_counters: dict[int, Counter] = {}


def counter_for(vocabulary: bytes) -> Counter:
    """The worker's counter, kept from task to task."""
    key = hash(vocabulary)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(vocabulary)
    return _counters[key]


def count_tokens(docs: DataFrame, vocabulary: bytes, text: str = "text",
                 limit: int = 512) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > ``limit``) to each row.

    ``vocabulary`` is the content of a tokenizer's JSON file (a few MB), sent to the
    executors once as a broadcast variable.
    """
    results = ["n_bytes", "n_tokens", "over_limit"]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in docs.columns if c not in results]
    source = docs.select(*keep)

    def run(batches):
        counter = counter_for(shared.value)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text)).fill_null("")
            n = np.fromiter((counter.text(v.as_py()) for v in col), np.int64, len(col))
            size = pc.cast(pc.binary_length(col), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, size, pa.array(n), pa.array(n > limit)],
                [*batch.schema.names, *results])

    return map_arrow(source, run, extended(source.schema, n_bytes=T.LongType(),
                                           n_tokens=T.LongType(), over_limit=T.BooleanType()))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under the public 50k byte-level vocabulary."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        vocabulary = f.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary).drop("text")
