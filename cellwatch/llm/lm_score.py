"""Language-model scores from a sharded Elias-Fano n-gram trie.

Model: words and an end mark; orders 1 .. N with recursive Dirichlet smoothing,

    p_k(w | c) = (count(c w) + m_k * p_(k-1)(w | c')) / (count(c) + m_k),

c' being the context without its first word. p_1 is the relative frequency, with the share of
words seen once set aside for unknown words (counted as one type). m_k is chosen so that the
mass given to shorter contexts equals the share of n-grams seen once. So a node needs only its
own and its parent's count: it stores the quantised logarithm of count(c w) / (count(c) + m_k),
rounded down, and as a context its quantised backoff weight m_k / (count + m_k), rounded down,
so no distribution sums to more than 1.

Trie: level 1 is the vocabulary in order of 64-bit word hashes; a node's number is its place. A
node of level k is a context (a node of level k - 1) and its last word's number, and its own
number is its place in order of context and word. So the successors of a context stand side by
side, and level k keeps, in Elias-Fano code (upper halves in unary, lower halves packed):

- for each context the place where its successors begin: a monotone sequence of pointers;
- the successors' words, each with the number of its context in the shard before it, which
  makes them one monotone sequence. Numbers are relative to the shard's first context, so their
  size doesn't depend on the corpus.

A query is a successor search: two pointers give the context's range, the unary part narrows
it, and halving finds the first word that is not smaller. A level is cut into shards by ranges
of contexts with about ``SHARD_TOKENS`` occurrences each, known from the level before; a context
with more is split by ranges of words, so a very frequent one is spread over several shards.
Level 1 is cut by ranges of hashes, which are spread too evenly for Elias-Fano code and are
kept as a plain sorted array.

Counting: a task sorts and counts the n-grams of its texts with numpy, deals them to shards and
emits one compressed row a shard; Spark shuffles the rows by shard, and the shard's task merges
them and writes the shard as one file of the shared folder. Scoring tasks map into memory the
files that their texts need (on a file system that is not mounted they read them); moving the
lookups to the shards instead would shuffle all n-grams of all texts twice a level. Nothing of
the model passes through the driver but the shards' names, sizes and bounds, a histogram of counts,
and totals. Every training n-gram is in the model: no pruning, no vocabulary limit.

Null or empty text: one token, the end mark. Very long texts are scored whole, in slices of rows.
An empty table gives an empty result. Texts without training rows have base and score
from an empty model (V = 0). Repeated rows are counted and scored each; a null id's bucket is
that of empty text. Columns of the input that bear a result's name are replaced.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extended, id_bucket, map_arrow, scratch, shuffles_dropped, table
from .textvec import SPACED, Words, column_bytes, row_slices

END = np.uint64(0x656E64206D61726B)          # hash of the end mark
ORDER = 3
SHARD_TOKENS = 4_000_000                     # occurrences of contexts for each shard of a level
SLICE = 8 << 20                              # bytes of texts handled at a time
HELD = 3_000_000                             # n-grams a task holds before it emits them
UNIT = 1 / 4096                              # step of quantised base-10 logarithms
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)         # number of a missing node


# --- monotone sequences -----------------------------------------------------------------

def _steps(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a new value begins in sorted ``x``, and for each place the number of its value."""
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return np.flatnonzero(first), np.cumsum(first) - 1


class EliasFano:
    """A sorted sequence of distinct 64-bit integers, as arrays that can be mapped from a file.

    ``low``: the lower bits of each value, in whole bytes. ``high``: for each value of the upper
    bits in turn, a one for each element and then a zero. ``zeros``: zeros before each word of 64.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.low, self.high, self.zeros = n, bits, low, high, zeros
        self.ones: np.ndarray | None = None                # ones before each word, once asked for

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = next((b for b in (8, 16, 32) if top >> b <= 4 * n + 64), 64)    # 64: plain
        kind = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}[bits]
        up = (values >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(n, np.int64)
        length = n + (int(up[-1]) if n else 0) + 1
        flags = np.zeros((length + 63) // 64 * 64, np.uint8)
        flags[up + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        per_word = 64 - np.bitwise_count(high).astype(np.int64)
        zeros = np.r_[0, np.cumsum(per_word)[:-1]].astype(np.uint32)
        return cls(n, bits, values.astype(kind), high, zeros)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        if self.bits == 64:
            return np.asarray(self.low, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)) | self.low.astype(np.uint64)

    @staticmethod
    def _select(bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Place of set bit number ``rest`` (from 0) of each word."""
        place = np.zeros(len(bits), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            below = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.uint64)
            skip = rest >= below
            rest = rest - np.where(skip, below, np.uint64(0))
            place += np.where(skip, w, np.uint64(0))
            bits = np.where(skip, bits >> w, bits)
        return place.astype(np.int64)

    def select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of zero number k (from 0) in ``high``."""
        word = np.searchsorted(self.zeros, k.astype(np.uint32), "right") - 1
        return word * 64 + self._select(~self.high[word], (k - self.zeros[word].astype(np.int64)).astype(np.uint64))

    def at(self, k: np.ndarray) -> np.ndarray:
        """Values number k (from 0)."""
        if self.bits == 64:
            return np.asarray(self.low, np.uint64)[k]
        if self.ones is None:
            self.ones = 64 * np.arange(len(self.zeros)) - self.zeros.astype(np.int64)
        word = np.searchsorted(self.ones, k, "right") - 1
        place = word * 64 + self._select(self.high[word], (k - self.ones[word]).astype(np.uint64))
        return ((place - k).astype(np.uint64) << np.uint64(self.bits)) | self.low[k].astype(np.uint64)

    def find(self, keys: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each of the sorted ``keys``, -1 where it is missing; ``begin`` and ``end``: where to look."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return out
        up = (keys >> np.uint64(self.bits)).astype(np.int64) if self.bits < 64 else np.zeros(len(keys), np.int64)
        total = int(self.zeros[-1]) + 64 - int(np.bitwise_count(self.high[-1]))
        at = np.flatnonzero(up < total if begin is None else (up < total) & (begin < end))
        if not len(at):
            return out
        up, low = up[at], keys[at].astype(self.low.dtype)
        # Elements with these upper bits lie between zero up - 1 and zero up.
        new, of = _steps(up)
        z = up[new]
        hi = (self.select_zero(z) - z)[of]
        before = np.zeros(len(z), np.int64)
        follows = np.r_[False, z[1:] == z[:-1] + 1]          # begins where the one before it ends
        before[follows] = hi[new[1:] - 1][follows[1:]]
        ask = np.flatnonzero(~follows & (z > 0))
        before[ask] = self.select_zero(z[ask] - 1) - (z[ask] - 1)
        lo = before[of]
        if begin is not None:
            lo, hi = np.maximum(lo, begin[at]), np.minimum(hi, end[at])
        stop = hi.copy()
        while True:                                          # the first that is not smaller
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.low[mid] < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        hit = lo < stop
        hit[hit] = self.low[lo[hit]] == low[hit]
        out[at[hit]] = lo[hit]
        return out


# --- files of the shared folder -----------------------------------------------------------

def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    """One file with the arrays; its path. A second try of a task writes a file of its own."""
    head = {k: (str(a.dtype), len(a)) for k, a in arrays.items()}
    body = repr(head).encode().ljust(2048)
    path = f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
    fs, p = pyarrow.fs.FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(p), recursive=True)
    with fs.open_output_stream(p) as f:
        f.write(body)
        for a in arrays.values():
            raw = np.ascontiguousarray(a).tobytes()
            f.write(raw + b"\0" * (-len(raw) % 64))
    return path


def read_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the folder is mounted."""
    import ast
    fs, p = pyarrow.fs.FileSystem.from_uri(path)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        raw = np.memmap(p, np.uint8, "r")
    else:
        with fs.open_input_file(p) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    out, at = {}, 2048
    for k, (kind, n) in ast.literal_eval(bytes(raw[:2048]).decode()).items():
        size = n * np.dtype(kind).itemsize
        out[k] = raw[at:at + size].view(kind) if size else np.empty(0, kind)
        at += size + -size % 64
    return out


def quantised(x: np.ndarray) -> np.ndarray:
    """Base-10 logarithms up to 0 in steps of UNIT, rounded down."""
    return np.minimum(np.ceil(-x / UNIT), 65535).astype(np.uint16)


def coded_counts(c: np.ndarray) -> np.ndarray:
    """Counts in 16 bits: exact below 2**15, above in steps of a 512th of a doubling."""
    big = np.minimum(32768 + np.floor(np.log2(np.maximum(c, 1)) * 512), 65535)
    return np.where(c < 32768, c, big).astype(np.uint16)


def decoded_counts(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.where(x < 32768, x, 2.0 ** ((x - 32768) / 512))


def sequence_arrays(name: str, seq: EliasFano) -> dict[str, np.ndarray]:
    return {f"{name}_head": np.array([seq.n, seq.bits], np.int64), f"{name}_low": seq.low, f"{name}_high": seq.high,
            f"{name}_zeros": seq.zeros}


def sequence_of(name: str, arrays: dict[str, np.ndarray]) -> EliasFano:
    n, bits = (int(x) for x in arrays[f"{name}_head"])
    return EliasFano(n, bits, *(arrays[f"{name}_{part}"] for part in ("low", "high", "zeros")))


def pointers(keys: np.ndarray, v: np.uint64) -> EliasFano:
    """Where the successors of each context begin in sorted ``keys`` (context * v + word). The
    context's number is added, so that equal pointers stay apart."""
    of = keys // v
    contexts = int(of[-1]) + 1 if len(keys) else 0
    begin = np.searchsorted(of, np.arange(contexts + 1, dtype=np.uint64))
    return EliasFano.build((begin + np.arange(contexts + 1)).astype(np.uint64))


class Shard:
    """A part of a level: successors, pointers, counts, and once smoothed the quantised logarithms."""

    def __init__(self, path: str, first: int, logs_path: str | None):
        a = read_arrays(path)
        self.first, self.count = first, a["count"]
        self.keys = sequence_of("keys", a)
        self.begin = sequence_of("begin", a) if "begin_head" in a else None
        logs = read_arrays(logs_path) if logs_path else {}
        self.own, self.back = logs.get("own"), logs.get("back")

    def range_of(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where the successors of sorted contexts (numbers in the shard) begin and end."""
        new, of = _steps(context)
        last = self.begin.n - 1
        one = np.minimum(context[new], last)
        after = np.minimum(one + 1, last)
        at = self.begin.at(np.r_[one, after]).astype(np.int64) - np.r_[one, after]
        return at[:len(new)][of], at[len(new):][of]

    def find(self, keys: np.ndarray, v: np.uint64) -> np.ndarray:
        """Places of sorted keys, -1 where they are missing."""
        if self.begin is None:
            return self.keys.find(keys)
        return self.keys.find(keys, *self.range_of((keys // v).astype(np.int64)))

    def contexts(self) -> np.ndarray:
        """The context (number in the shard) of each place."""
        begin = self.begin.values().astype(np.int64) - np.arange(self.begin.n)
        return np.repeat(np.arange(self.begin.n - 1), np.diff(begin))


def dealt(model: dict, level: int, context: np.ndarray | None, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each n-gram and its key there."""
    if level == 1:
        shards = np.uint64(model["shards"])
        return ((word >> np.uint64(32)) * shards >> np.uint64(32)).astype(np.int64), word
    cut_context, cut_word = model["cuts"][level]           # where each shard but the first begins
    shard = np.searchsorted(cut_context, context, "right")
    split = np.flatnonzero(np.r_[NONE, cut_context][shard] == context)
    split = split[np.argsort(context[split], kind="stable")]
    at, begin = np.unique(context[split], return_index=True)         # a shard begins at, or inside, each of these
    for c, mine in zip(at, np.split(split, begin[1:])):
        a, z = np.searchsorted(cut_context, c, "left"), np.searchsorted(cut_context, c, "right")
        shard[mine] = a + np.searchsorted(cut_word[a:z], word[mine], "right")
    first = np.r_[np.uint64(0), cut_context][shard]
    return shard, (context - first) * np.uint64(model["v"]) + word


def by_shard(shard: np.ndarray):
    """(shard, its places) of each shard that occurs."""
    order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    there = shard[order]
    cut = np.flatnonzero(np.r_[True, there[1:] != there[:-1]]) if len(there) else np.empty(0, np.int64)
    for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(there)]):
        yield int(there[a]), order[a:z]


class Trie:
    """The levels of a model as the shared folder has them; shards are opened when first used."""

    def __init__(self, model: dict):
        self.model = model
        self.open: dict[tuple[int, int], Shard] = {}

    def shard(self, level: int, s: int) -> Shard | None:
        if (level, s) not in self.open:
            file = self.model["levels"][level]["files"][s]
            self.open[level, s] = Shard(*file) if file else None
        return self.open[level, s]

    def nodes(self, level: int, context: np.ndarray | None, word: np.ndarray):
        """Node number, own and back logarithms and (level 1) count of n-grams; a context that is
        NONE has no successor."""
        node = np.full(len(word), NONE)
        own, back = (np.zeros(len(word), np.uint16) for _ in range(2))
        count = np.zeros(len(word), np.int64)
        asked = np.arange(len(word)) if context is None else np.flatnonzero(context != NONE)
        shard, key = dealt(self.model, level, None if context is None else context[asked], word[asked])
        for s, mine in by_shard(shard):
            part = self.shard(level, s)
            if part is None:
                continue
            distinct, inverse = np.unique(key[mine], return_inverse=True)
            at = part.find(distinct, np.uint64(self.model["v"]))[inverse]
            hit = at >= 0
            mine, at = asked[mine[hit]], at[hit]
            node[mine] = (at + part.first).astype(np.uint64)
            if part.own is not None:
                own[mine] = part.own[at]
                if len(part.back):
                    back[mine] = part.back[at]
            if level == 1:
                count[mine] = part.count[at]
        return node, own, back, count

    def counts(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Counts of nodes by their sorted numbers."""
        out = np.zeros(len(nodes))
        files = self.model["levels"][level]["files"]
        there = [s for s, f in enumerate(files) if f]
        first = np.array([files[s][1] for s in there], np.uint64)
        for i, mine in by_shard(np.searchsorted(first, nodes, "right") - 1):
            part = self.shard(level, there[i])
            c = part.count[(nodes[mine] - first[i]).astype(np.int64)]
            out[mine] = c if level == 1 else decoded_counts(c)
        return out


_tries: dict[str, Trie] = {}


def trie_for(model: dict) -> Trie:
    """The worker's view of a model, kept from task to task."""
    if model["name"] not in _tries:
        _tries.clear()
        _tries[model["name"]] = Trie(model)
    return _tries[model["name"]]


# --- tokens --------------------------------------------------------------------------------

def token_hashes(col) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then its end mark; texts: row[i]:row[i+1]."""
    w = Words(col, SPACED)
    texts = len(w.row) - 1
    row = w.row + np.arange(texts + 1)
    out = np.full(len(w.hash) + texts, END)
    out[np.arange(len(w.hash)) + np.repeat(np.arange(texts), np.diff(w.row))] = w.hash
    return out, row


def walk(trie: Trie, hashes: np.ndarray, row: np.ndarray, level: int):
    """Yields (k, contexts, words, values) of every token's n-gram for k = 1 .. ``level``.

    A context is NONE where the text is too short before the token or a part is not in the trie;
    ``values``: as :meth:`Trie.nodes`, None for a level that the trie does not have yet.
    """
    first = np.zeros(len(hashes), bool)
    first[row[:-1][row[:-1] < len(hashes)]] = True
    values = trie.nodes(1, None, hashes)
    yield 1, None, hashes, values
    word = node = values[0]
    for k in range(2, level + 1):
        context = np.where(first | (word == NONE), NONE, np.r_[NONE, node[:-1]])
        values = trie.nodes(k, context, word) if k in trie.model["levels"] else None
        yield k, context, word, values
        if values is None:
            return
        node = values[0]


# --- counting -------------------------------------------------------------------------------

def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart, and counts; compressed."""
    gaps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    many = counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(gaps + many, "zstd", asbytes=True)


def _unpack(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, 12 * n, "zstd", asbytes=True), np.uint8)
    gaps = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view(np.uint32).ravel()


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[new], np.add.reduceat(counts.astype(np.int64), new) if len(new) else np.empty(0, np.int64)


def counted(texts: DataFrame, level: int, model: dict) -> DataFrame:
    """shard, n, blob: the n-grams of order ``level`` of each task, dealt to shards."""
    def run(batches):
        held, size = [], 0

        def emit():
            shard, key = (np.concatenate(x) for x in zip(*held))
            for s, mine in by_shard(shard):
                keys, counts = np.unique(key[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()),
                    pa.array([_pack(keys, counts)], pa.binary())], ["shard", "n", "blob"])

        for batch in batches:
            col = batch.column(0)
            _, off = column_bytes(col)
            for i, j in row_slices(off, SLICE):
                word, row = token_hashes(col.slice(i, j - i))
                context = None
                if level > 1:
                    *_, (_, context, word, _) = walk(trie_for(model), word, row, level)
                    there = context != NONE
                    context, word = context[there], word[there]
                held.append(dealt(model, level, context, word))
                size += len(word)
                if size >= HELD:
                    yield from emit()
                    held, size = [], 0
        if size:
            yield from emit()

    return map_arrow(texts, run, "shard int, n bigint, blob binary")


def cuts_of(counts: np.ndarray, tokens: int) -> tuple[list[int], list[int], list[int]]:
    """Where shards of the next level begin among a shard's nodes as contexts, each with about
    ``tokens`` occurrences: (node, j, pieces), j and pieces naming a part of a frequent node."""
    before = np.cumsum(counts) - counts
    node = np.flatnonzero(np.r_[True, np.diff(before // tokens) > 0]) if len(counts) else np.empty(0, np.int64)
    many = np.flatnonzero(counts >= 2 * tokens)
    pieces = -(-counts[many] // tokens)
    out = [(int(i), 0, 1) for i in node]
    out += [(int(i), j, int(k)) for i, k in zip(many, pieces) for j in range(1, int(k))]
    out = sorted(out, key=lambda c: (c[0], c[1] / c[2]))
    return tuple(map(list, zip(*out))) if out else ([], [], [])


BINS = 160                                    # of counts, four to a doubling
def _add_level(texts: DataFrame, level: int, model: dict) -> dict:
    """Count the n-grams of one order into the shared folder; describes the level."""
    folder, tokens, v = model["folder"], model["shard_tokens"], np.uint64(model["v"])

    def merge(group: pa.Table) -> pa.Table:
        s = group["shard"][0].as_py()
        keys, counts = _merged(*(np.concatenate(x) for x in zip(*(
            _unpack(b.as_py(), n.as_py()) for b, n in zip(group["blob"], group["n"])))))
        arrays = sequence_arrays("keys", EliasFano.build(keys))
        if level > 1:
            arrays |= sequence_arrays("begin", pointers(keys, v))
        path = write_arrays(folder, f"level-{level}-{s}", arrays | {"count": counts if level == 1 else coded_counts(counts)})
        b = np.minimum((np.log2(counts) * 4).astype(np.int64), BINS - 1)
        cut_node, cut_part, cut_pieces = cuts_of(counts, tokens)
        return pa.table({"shard": pa.array([s], pa.int32()), "path": [path], "n": [len(keys)],
                         "total": [int(counts.sum())], "once": [int((counts == 1).sum())],
                         "bins": [np.bincount(b, minlength=BINS).tolist()],
                         "sums": [np.bincount(b, counts.astype(np.float64), BINS).tolist()],
                         "cut_node": pa.array([cut_node], pa.list_(pa.int64())),
                         "cut_part": pa.array([cut_part], pa.list_(pa.int64())),
                         "cut_pieces": pa.array([cut_pieces], pa.list_(pa.int64()))})

    with shuffles_dropped(texts.sparkSession):                       # a level's, before the next is counted
        done = counted(texts, level, model).groupBy("shard").applyInArrow(
            merge, "shard int, path string, n bigint, total bigint, once bigint, bins array<bigint>, sums array<double>, "
                   "cut_node array<bigint>, cut_part array<bigint>, cut_pieces array<bigint>")
        rows = sorted(done.collect(), key=lambda r: r["shard"])      # a row for each shard
    shards = model["shards"] if level == 1 else len(model["cuts"][level][0]) + 1
    out = {"nodes": sum(r["n"] for r in rows), "tokens": sum(r["total"] for r in rows),
           "once": sum(r["once"] for r in rows), "files": [None] * shards, "strength": None,
           "bins": np.sum([r["bins"] for r in rows] or [[0] * BINS], axis=0),
           "sums": np.sum([r["sums"] for r in rows] or [[0.0] * BINS], axis=0)}
    if level == 1:
        model["v"] = max(1, out["nodes"])
    first, cuts = 0, []
    for r in rows:
        out["files"][r["shard"]] = (r["path"], first, None)
        cuts += [(first + c, model["v"] * j // k) for c, j, k in zip(r["cut_node"], r["cut_part"], r["cut_pieces"])]
        first += r["n"]
    cuts = cuts[1:]                                                  # the first shard begins at the first context
    model["cuts"][level + 1] = (np.array([c for c, _ in cuts], np.uint64), np.array([w for _, w in cuts], np.uint64))
    return out


def _strength(contexts: dict, level: dict) -> float:
    """m so that contexts give away, by their counts, the share of n-grams seen once."""
    share = min(0.999, max(0.001, level["once"] / max(1, level["tokens"])))
    c = contexts["sums"]
    mean = c / np.maximum(contexts["bins"], 1)
    lo, hi = 1e-3, 1e9
    for _ in range(80):
        m = (lo * hi) ** 0.5
        lo, hi = (m, hi) if (c * m / (mean + m)).sum() / max(1.0, c.sum()) < share else (lo, m)
    return m


def _smooth(spark: SparkSession, model: dict, level: int) -> None:
    """Write the quantised logarithms of a level's shards beside their keys."""
    here, above = model["levels"][level], model["levels"].get(level + 1)
    strength, next_strength = here["strength"], above["strength"] if above else None
    total, unknown, folder = here["tokens"], model["unknown"], model["folder"]

    def run(batches):
        trie = trie_for(model)
        for batch in batches:
            done = []
            for s in batch.column(0).to_pylist():
                part = trie.shard(level, s)
                c = part.count.astype(np.float64) if level == 1 else decoded_counts(part.count)
                if level == 1:
                    own = np.log10(c / total * (1 - unknown))
                else:
                    start = model["cuts"][level][0][s - 1] if s else np.uint64(0)
                    at, inverse = np.unique(part.contexts().astype(np.uint64) + start, return_inverse=True)
                    own = np.log10(c / (trie.counts(level - 1, at)[inverse] + strength))
                back = quantised(np.log10(next_strength / (c + next_strength))) if above else np.empty(0, np.uint16)
                done.append((s, write_arrays(folder, f"logs-{level}-{s}", {"own": quantised(own), "back": back})))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.int32(), pa.string()))],
                                                 ["shard", "path"])

    shards = [s for s, f in enumerate(here["files"]) if f]
    if not shards:
        return
    listed = spark.range(len(here["files"]), numPartitions=len(here["files"])).selectExpr("cast(id as int) as shard")
    listed = listed.where(F.col("shard").isin(shards))
    for r in map_arrow(listed, run, "shard int, path string").collect():
        path, first, _ = here["files"][r["shard"]]
        here["files"][r["shard"]] = (path, first, r["path"])


def learn_model(texts: DataFrame, order: int = ORDER, shard_tokens: int = SHARD_TOKENS) -> dict:
    """The model of a one-column frame of texts: a description of its files."""
    spark = texts.sparkSession
    folder = scratch(spark, "lm")
    words = texts.select(F.coalesce(F.sum(F.length(texts.columns[0])), F.lit(0))).first()[0] // 6
    model = {"name": "", "folder": folder, "order": order, "levels": {}, "unknown": 1.0, "v": 1, "cuts": {},
             "shards": max(1, -(-words // shard_tokens)), "shard_tokens": shard_tokens}
    for level in range(1, order + 1):
        model["levels"][level] = _add_level(texts, level, model)
        model["name"] = f"{folder}/{level}"
        here = model["levels"][level]
        if level == 1:
            model["unknown"] = (here["once"] + 1) / (here["tokens"] + 2) if here["tokens"] else 1.0
        else:
            here["strength"] = _strength(model["levels"][level - 1], here)
    for level in range(1, order + 1):
        _smooth(spark, model, level)
    for level in model["levels"].values():
        level["bins"] = level["sums"] = None
    model["name"] = f"{folder}/smoothed"
    return model


# --- scoring --------------------------------------------------------------------------------

def score_rows(trie: Trie, col):
    """n_tokens, n_known, base_score and score of each row of a string column."""
    model, top = trie.model, trie.model["order"]
    one = model["levels"][1]
    n, v = one["tokens"], one["nodes"]
    hashes, row = token_hashes(col)
    before = None
    for k, _, _, (node, own, back, count) in walk(trie, hashes, row, top):
        found = node != NONE
        ten = 10.0 ** (-UNIT * own.astype(np.float64))
        if k == 1:
            p = np.where(found, ten, model["unknown"])
            known = found
            base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
        else:
            # The context's backoff weight, 1 where it is not in the trie or the text begins.
            has = np.r_[False, before[0][:-1]]
            has[row[:-1]] = False
            weight = np.where(has, np.r_[1.0, 10.0 ** (-UNIT * before[1][:-1].astype(np.float64))], 1.0)
            p = np.where(found, ten, 0.0) + weight * p
        before = found, back
    sums = lambda x: np.add.reduceat(x, row[:-1])  # noqa: E731  every text has a token
    return np.diff(row), sums(known.astype(np.int64)), sums(base), sums(np.log10(np.minimum(p, 1.0)))


RESULTS = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(),
           "base_score": T.DoubleType(), "score": T.DoubleType()}


def score_texts(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with token counts, the unigram base score and the model's score of each text."""
    keep = docs.select(*[c for c in docs.columns if c not in RESULTS])

    def run(batches):
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            _, off = column_bytes(col)
            parts = [score_rows(trie_for(model), col.slice(i, j - i)) for i, j in row_slices(off, SLICE)]
            tokens, known, base, score = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0)] * 4
            whole = np.full(len(tokens), model["levels"][1]["tokens"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, t) for c, t in zip(
                    (tokens, known, whole, base, score),
                    (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())))],
                [*batch.schema.names, *RESULTS])

    return map_arrow(keep, run, extended(keep.schema, **RESULTS))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of those whose id bucket (crc32 mod 10) is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_bucket(F.col("doc_id"), 10) == 0
    model = learn_model(docs.where(~held).select("text"))
    return score_texts(docs.withColumn("held_out", held), model).drop("text")
